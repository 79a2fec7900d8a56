import datetime as dt

from pyspark.sql import functions as F

from shelfcast.operators.cleaning import Link, clean_dedup, clean_link_check, clean_nulls, clean_standardise
from shelfcast.operators.quality import KeySet, Reference, key_counts, quality_report, sales_reconciliation
from shelfcast.sources.scan import scan_typed


def test_standardise(spark):
    df = spark.createDataFrame(
        [(" ab ", "2001-02-03 04:05:06", 1.005), ("", None, None)], "code string, at string, amount double"
    ).withColumn("at", F.col("at").cast("timestamp_ntz"))
    rows = clean_standardise(df, ["at"], ["code"], ["amount"]).collect()
    assert (rows[0]["code"], rows[0]["at"], float(rows[0]["amount"])) == ("AB", dt.date(2001, 2, 3), 1.01)
    assert rows[0]["amount_rounded"]
    assert tuple(rows[1]) == (None, None, None, False, False, False)


def test_bad_values_are_flagged_and_do_not_end_the_job(spark):
    df = spark.createDataFrame(
        [("2020-13-45", "1,5", float("nan")), ("2020-01-02", "1.5", 1e30), (None, None, 2.5)],
        "at string, amount string, price double",
    )
    rows = clean_standardise(df, dates=["at"], amounts=["amount", "price"]).collect()
    assert [r["at_invalid"] for r in rows] == [True, False, False]
    assert [r["amount_invalid"] for r in rows] == [True, False, False]
    assert [r["price_invalid"] for r in rows] == [False, True, False]
    assert (rows[0]["at"], rows[0]["amount"], rows[0]["price"], rows[1]["price"]) == (None, None, None, None)
    assert (rows[1]["at"], float(rows[1]["amount"])) == (dt.date(2020, 1, 2), 1.5)


def test_corrupt_csv_lines_are_kept(spark, tmp_path):
    (tmp_path / "sales.csv").write_text("Date,Revenue\n2020-01-01,1.5\n2020-01-02,1.2.3\n")
    rows = scan_typed(spark, str(tmp_path), "Date string, Revenue double", file_format="csv", corrupt="bad").collect()
    assert [(r["Date"], r["Revenue"], r["bad"]) for r in rows] == [
        ("2020-01-01", 1.5, None), ("2020-01-02", None, "2020-01-02,1.2.3"),
    ]


def test_dedup_is_deterministic_and_null_first(spark):
    rows = [
        (1, 1, 5.0, "b"), (1, 1, 5.0, "a"), (1, 1, 5.0, "a"), (1, 2, None, "z"), (1, 2, 0.0, "a"), (2, 1, 3.0, None),
    ]
    df = spark.createDataFrame(rows, "k int, n int, v double, s string")
    wanted = {(1, 1, 5.0, "a"), (1, 2, None, "z"), (2, 1, 3.0, None)}
    for order in (F.col("s"), F.desc("s")):
        got = clean_dedup(df.repartition(3).orderBy(order), ["k", "n"])
        assert {tuple(r) for r in got.collect()} == wanted
        assert got.columns == df.columns


def test_nulls_and_nan_are_filled_and_flagged(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),)], "x double")
    rows = clean_nulls(df, {"x": F.lit(9.0)}).collect()
    assert [(r["x"], r["x_missing"]) for r in rows] == [(1.0, False), (9.0, True), (9.0, True)]


def test_links_report_both_directions(spark):
    lines = spark.createDataFrame([(1,), (1,), (3,), (3,), (None,)], "order_id long")
    orders = spark.createDataFrame([(1,), (2,)], "order_id long")
    got = clean_link_check([Link("lines", lines, "order_id", orders, "order_id")]).collect()
    assert {(r["direction"], r["orphan_key"], r["row_count"]) for r in got} == {
        ("child_without_parent", "3", 2), ("child_without_parent", None, 1), ("parent_without_child", "2", 1),
    }


def test_links_of_text_keys(spark):
    lines = spark.createDataFrame([("A-1",), ("B-2",)], "code string")
    parts = spark.createDataFrame([("B-2",)], "code string")
    got = clean_link_check([Link("lines", lines, "code", parts, "code")]).collect()
    assert [(r["direction"], r["orphan_key"]) for r in got] == [("child_without_parent", "A-1")]


def test_quality_report_counts(spark):
    lines = spark.createDataFrame(
        [(1, 1, "2001-01-01"), (1, 1, "2001-01-01"), (7, 1, None), (7, 2, "2001-01-02")],
        "order_id long, line_no int, at string",
    )
    orders = spark.createDataFrame([(1,)], "order_id long")
    keys = KeySet("lines", ["order_id", "line_no"], ["order_id"], lines.columns, bad=F.col("at").isNull())
    counts = key_counts(lines, [keys])
    children = counts.select(F.col("order_id").alias("key"), F.col("row_count").alias("rows"))
    parents = {"orders": orders.select(F.col("order_id").alias("key"))}
    row = quality_report(["lines"], [counts], [Reference(["lines"], children, "orders")], parents).first()
    assert row.asDict() == {
        "table_name": "lines", "row_count": 4, "null_cells": 1, "duplicate_rows": 1, "orphan_rows": 2, "bad_dates": 1,
    }


def test_reconciliation_keeps_one_sided_days(spark):
    d = [dt.date(2001, 1, i) for i in (1, 2, 3)]
    series = spark.createDataFrame([(d[0], 100.0), (d[1], 50.0)], "date date, revenue double")
    lines = spark.createDataFrame([(d[0], 30.0), (d[0], 60.0), (d[2], 5.0)], "order_date date, net double")
    got = {r["date"]: (r["difference"], r["difference_pct"], r["missing_side"]) for r in
           sales_reconciliation(series, lines).collect()}
    assert got == {
        d[0]: (10.0, 10.0, "none"), d[1]: (50.0, 100.0, "transactions"), d[2]: (-5.0, None, "series"),
    }


def test_typed_csv_scan(spark, tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text("Date,Revenue,COGS\n2012-07-04,10.5,NaN\n2012-07-05,,3\n")
    df = scan_typed(spark, str(path), "Date string, Revenue double, COGS double", ["Date"], "csv")
    assert dict(df.dtypes)["Date"] == "date"
    assert [tuple(r) for r in df.orderBy("Date").collect()] == [
        (dt.date(2012, 7, 4), 10.5, None), (dt.date(2012, 7, 5), None, 3.0),
    ]
