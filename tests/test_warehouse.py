"""Laws between layers, on the test tables and on small skewed ones."""

import datetime as dt
import os
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import dims, facts, features
from shelfcast.plans import marts, reports, warehouse
from shelfcast.plans.queries import run
from shelfcast.plans.warehouse import DATA_LAYERS, LAYERS, YEAR_OF, Warehouse
from shelfcast.session import publish_folder, shared_folder
from shelfcast.sources.publish import forecast_publish, publish_table


@pytest.fixture(scope="module")
def w(spark, small):
    return Warehouse(spark, small)


def total(df, column):
    return df.agg(F.sum(column)).first()[0]


def test_marts_add_up_to_the_fact(w):
    lines = w.table("fact_sales_item")
    net, profit = total(lines, "net"), total(lines, "net_profit")
    assert total(w.table("mart_sales_overview"), "revenue") == net
    assert total(w.table("mart_sales_overview"), "profit") == profit
    assert total(w.table("mart_product_performance"), "revenue") == net
    assert total(w.table("mart_customer_insight"), "revenue") == net
    assert total(w.table("mart_return_diagnostics"), "return_amount") == total(lines, "return_amount")
    assert total(w.table("mart_shipping_service"), "lines") == lines.count()
    assert total(reports.report_business_overview(w.table("fact_orders")), "revenue") == net


def test_grouping_sets_add_up_per_level(w):
    report = reports.report_profit_diagnostic(w.table("fact_sales_item"), w.table("dim_promotion"))
    sums = {r["level"]: r["s"] for r in report.groupBy("level").agg(F.sum("revenue").alias("s")).collect()}
    assert set(sums) == {"promotion", "category", "region", "total"}
    assert len(set(sums.values())) == 1


def test_every_order_is_in_the_order_fact(w, spark, small):
    orders = w.table("fact_orders")
    assert orders.count() == w.raw("orders").count() == orders.select("order_id").distinct().count()
    assert total(orders, "line_count") == w.raw("lineitem").count()
    assert orders.where("line_count = 0").count() > 0


def test_segment_orders_equal_distinct_orders(w):
    lines = w.table("fact_sales_item")
    report = reports.report_segment_insight(lines, w.table("fact_reviews"))
    got = {(r["segment_type"], r["segment"]): r["orders"] for r in report.collect()}
    for kind in ("age_group", "category", "region"):
        for r in lines.groupBy(kind).agg(F.countDistinct("order_id").alias("n")).collect():
            assert got[kind, r[0]] == r["n"]


def test_features_of_training_days_do_not_see_the_horizon(w):
    """Changing the horizon's orders leaves the expected values alone."""
    is_train = w.is_train()
    days = w.table("sales").where(~is_train).select("date")
    operations = w.table("daily_operations")
    spoiled = operations.withColumns(
        {c: F.when(is_train, F.col(c)).otherwise(F.lit(1e9)) for c in ("aov", "item_sold", "unique_order")}
    )
    before = features.feat_expected_median(days, operations, is_train).orderBy("date").collect()
    after = features.feat_expected_median(days, spoiled, is_train).orderBy("date").collect()
    assert before == after and len(before) == 83


def test_split_payment_does_not_repeat_lines(spark):
    payments = spark.createDataFrame(
        [(1, "card", Decimal("10.00")), (1, "cash", Decimal("5.00"))],
        "order_id long, payment_method string, payment_value decimal(12,2)",
    )
    row = facts.order_payments(payments).first()
    assert (row["payment_method"], row["payment_value"]) == ("card", Decimal("15.00"))


def test_hot_order_and_hot_customer_overview(spark):
    """A third of all lines in one order; counts stay distinct counts."""
    rows = [(0, 0, "A", "N", 1.0)] * 300 + [(0, 0, "B", "N", 1.0)] * 50
    rows += [(i, i % 7, "AB"[i % 2], "N", 2.0) for i in range(1, 500)]
    frame = spark.createDataFrame(rows, "order_id long, customer_id long, category string, region string, net double")
    lines = frame.withColumn("order_date", F.lit(dt.date(2001, 1, 1))).withColumns(
        {c: F.col("net") for c in ("shipping_fee", "cogs", "return_amount")}
    )
    got = {r["category"]: (r["orders"], r["customers"], r["revenue"]) for r in
           marts.mart_sales_overview(lines.repartition(7)).collect()}
    for category in "AB":
        mine = [r for r in rows if r[2] == category]
        assert got[category] == (len({r[0] for r in mine}), len({r[1] for r in mine}), sum(r[4] for r in mine))


def test_day_with_one_cancelled_order_without_items(spark):
    orders = spark.createDataFrame(
        [(1, 5, dt.date(2001, 1, 1), True, Decimal("80.00")) + (Decimal(0),) * 5],
        "order_id long, customer_id long, order_date date, is_cancelled boolean, payment_value decimal(12,2),"
        " units decimal(28,4), return_amount decimal(28,4), shipping_fee decimal(28,4), cogs decimal(28,4),"
        " net_profit decimal(28,4)",
    )
    customers = spark.createDataFrame([(6, "MACHINERY")], "customer_id long, age_group string")
    row = features.daily_operations(orders, customers).first()
    assert (row["unique_order"], row["item_sold"], row["aov"], row["cancel_rate"]) == (1, 0.0, 80.0, 1.0)
    assert row[features.OTHER_AGES] == 1
    assert sum(row[name] for name in features.AGE_FEATURES) == row["unique_order"]


def test_abnormal_month_is_found(spark):
    months = [dt.date(2000 + i // 12, i % 12 + 1, 1) for i in range(30)]
    rows = [(m, Decimal(100 + i % 2) * (9 if i == 20 else 1)) for i, m in enumerate(months)]
    orders = spark.createDataFrame(rows, "order_date date, net decimal(28,4)")
    got = [(r["month"], r["direction"]) for r in reports.report_abnormal_growth(orders).orderBy("month").collect()]
    assert got[0] == (months[20], "growth")
    assert months[21] not in [m for m, d in got if d == "growth"]


def monthly_orders(spark, revenues):
    months = [dt.date(2000 + i // 12, i % 12 + 1, 1) for i in range(len(revenues))]
    return months, spark.createDataFrame(list(zip(months, map(Decimal, revenues))), "order_date date, net decimal(28,4)")


def test_a_month_without_revenue_does_not_blind_the_report(spark):
    revenues = [100 + i % 2 for i in range(30)]
    revenues[16], revenues[22] = 0, 900
    months, orders = monthly_orders(spark, revenues)
    got = {r["month"]: r["direction"] for r in reports.report_abnormal_growth(orders).collect()}
    assert got[months[22]] == "growth"


def test_a_spike_after_a_flat_history_is_found(spark):
    revenues = [100] * 30
    revenues[20] = 900
    months, orders = monthly_orders(spark, revenues)
    got = {r["month"]: (r["direction"], r["z_score"]) for r in reports.report_abnormal_growth(orders).collect()}
    assert got[months[20]] == ("growth", None)
    assert months[19] not in got


def test_code_ids_stay_when_a_code_appears(spark):
    def ids(codes):
        frame = spark.createDataFrame([(c,) for c in codes], "reason string")
        return {r["return_reason"]: r["return_reason_id"] for r in dims.dim_return_reason(frame).collect()}

    few, more = ids(["F", "O", None, "O"]), ids(["A", "F", "G", "O"])
    assert len(few) == 2 and len(set(more.values())) == 4
    assert all(more[code] == number for code, number in few.items())


def test_facts_and_rejected_lines_add_up(spark, w):
    orders = w.table("orders").where("order_id % 5 <> 0")
    items = w.table("order_items")
    rejected = facts.rejected_lines(items, orders)
    names = ("units", "gross", "net", "cogs", "shipping_fee", "return_amount", "net_profit")
    sums = [F.sum(c).alias(c) for c in names]
    whole = items.agg(*sums).first()
    parts = facts.sales_lines(items, orders).select(*names).unionByName(rejected.select(*names)).agg(*sums).first()
    assert rejected.count() > 0 and whole == parts


def test_an_opened_warehouse_reads_what_was_published(spark, w):
    root = publish_folder(spark, "reopened")
    built = Warehouse(spark, w.source)
    assert built.kept_counts("dim") is None
    for layer in ("processed", "dim", "fact", "mart"):
        built.publish_layer(layer, LAYERS[layer], root)
    opened = Warehouse.open(spark, w.source, root)
    for layer in ("dim", "fact", "mart"):
        for name in LAYERS[layer]:
            assert sorted(opened.table(name).columns) == sorted(built.table(name).columns)
    counts = {r["table_name"]: r["row_count"] for r in opened.table("table_inventory").collect()}
    assert counts["fact_sales_item"] == built.table("fact_sales_item").count()
    for name in ("table_inventory", "processed_table_summary"):  # counted by the jobs that wrote the tables
        files = opened.table(name).inputFiles()
        assert files and all("table_counts" in f for f in files)
        counted = Warehouse(spark, w.source).table(name)
        assert sorted(map(tuple, opened.table(name).select(*counted.columns).collect())) == sorted(
            map(tuple, counted.collect())
        )
    assert not any("lineitem" in f for f in opened.table("mart_operations").inputFiles())
    report = reports.report_business_overview(opened.table("fact_orders"))
    assert report.count() == reports.report_business_overview(w.table("fact_orders")).count()


def test_published_layers(spark, w):
    root = publish_folder(spark, "test")
    assert root.startswith(shared_folder(spark))
    fresh = Warehouse(spark, w.source)
    fresh.publish_layer("processed", ("sales", "orders", "order_items", "payments"), root)
    fresh.publish_layer("fact", ("fact_orders",), root)
    path = os.path.join(root, "fact", "fact_orders")
    assert {d for d in os.listdir(path) if d.startswith("year=")} == {f"year={y}" for y in range(1995, 2002)}
    read = spark.read.parquet(path).drop("year")
    assert sorted(read.columns) == sorted(w.table("fact_orders").columns)
    assert read.exceptAll(w.table("fact_orders").select(*read.columns)).count() == 0
    assert set(YEAR_OF) <= {name for layer in DATA_LAYERS for name in LAYERS[layer]}


def test_forecast_file(spark, tmp_path):
    forecast = spark.createDataFrame(
        [(dt.date(2023, 1, 2), 3.5, 1.25), (dt.date(2023, 1, 1), 2.0, 1.0)],
        "date date, revenue_pred double, cogs_pred double",
    )
    path = tmp_path / "out"
    forecast_publish(forecast, str(path))
    lines = [line for part in sorted(path.glob("part-*.csv")) for line in part.read_text().splitlines()]
    assert [line for line in lines if line != "Date,Revenue,COGS"] == ["2023-01-01,2.0,1.0", "2023-01-02,3.5,1.25"]
    assert lines[0] == "Date,Revenue,COGS"


def test_plain_publish_keeps_every_row_and_counts_it(spark, tmp_path):
    df = spark.range(1000).withColumn("d", F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") % 800).cast("int")))
    seen = publish_table(df, str(tmp_path / "t"), date="d")
    assert spark.read.parquet(str(tmp_path / "t")).count() == seen["row_count"] == 1000
    assert (seen["first_date"], seen["last_date"]) == (dt.date(2000, 1, 1), dt.date(2002, 3, 10))
    yearly = publish_table(df.where("id < 0"), str(tmp_path / "y"), "d", "d")
    assert yearly == {"row_count": 0, "first_date": None, "last_date": None}


def test_counts_of_a_table_published_again_are_replaced(spark, w):
    root = publish_folder(spark, "again")
    once = Warehouse(spark, w.source)
    once.publish_layer("dim", LAYERS["dim"], root)
    before = {r["table_name"]: r["row_count"] for r in once.kept_counts("dim").collect()}
    few = Warehouse(spark, w.source)
    few._tables["dim_customer"] = w.table("dim_customer").limit(3)
    few.publish_layer("dim", ("dim_customer",), root)
    after = {r["table_name"]: r["row_count"] for r in few.kept_counts("dim").collect()}
    assert after == {**before, "dim_customer": 3}


def test_queries_do_not_depend_on_the_session_time_zone(spark, small):
    before = spark.conf.get("spark.sql.session.timeZone")
    names = ("fact_web_traffic", "seasonal_forecast", "feat_calendar")
    rows = {name: sorted(map(str, run(name, spark, small).collect())) for name in names}
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        for name in names:
            assert sorted(map(str, run(name, spark, small).collect())) == rows[name]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_long_tables_are_written_one_at_a_time_and_leave_no_shuffle_files(spark, tmp_path, monkeypatch):
    """Shuffle files of one long table lie on the disks at a time, and go with the job that made them."""
    open_now, most, cleared = [], [], []
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    publish, held = warehouse.publish_table, spark.conf.get(key, None)

    def watched(df, path, year_of=None, date=None):
        name = path.rsplit("/", 1)[1]
        open_now.append(name)
        most.append(sum(n in warehouse.LONG for n in open_now))
        cleared.append(spark.conf.get(key))
        time.sleep(0.2)
        seen = publish(df, path, year_of, date)
        open_now.remove(name)
        return seen

    monkeypatch.setattr(warehouse, "publish_table", watched)
    w = Warehouse(spark, "nowhere")
    names = ("orders", "shipments", "payments", "customers", "geography")
    for n, name in enumerate(names):
        days = spark.range(40).selectExpr("id % 7 as k", "date '1999-12-20' + cast(id as int) as order_date", "current_date() as ship_date")
        w.use(name, days.groupBy("order_date", "ship_date").agg(F.count("k").alias("n"), F.lit(n).alias("of")), published=False)
    w.publish_layer("processed", names, str(tmp_path))
    assert max(most) == 1 and cleared == ["true"] * len(names)
    assert spark.conf.get(key, None) == held
    for n, name in enumerate(names):
        assert {(r["n"], r["of"]) for r in w.table(name).collect()} == {(1, n)} and w.table(name).count() == 40
    kept = {r["table_name"]: r["row_count"] for r in w._counts.collect()}
    assert kept == dict.fromkeys(names, 40)
    codecs = {p.name.split(".")[-2] for p in tmp_path.glob("processed/**/*.parquet")}
    assert codecs == {"zstd"}
