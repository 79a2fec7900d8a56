"""A second run with new rows rewrites their years alone, and gives what a full run gives."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from shelfcast.operators.sessions import web_sessions
from shelfcast.plans.increment import Touched, publish_since, touched_years
from shelfcast.plans.warehouse import DATA_LAYERS, LAYERS, YEAR_OF, Warehouse
from shelfcast.session import publish_folder

TABLES = ("region", "nation", "customer", "part", "documents", "labels", "orders", "lineitem", "events")
SINCE = dt.date(2001, 6, 1)


def source(spark, small, folder, later: bool):
    """The test tables, lines shipped after their order; ``later`` holds what came from SINCE on, and a line of a new
    order that seems to have been shipped long before."""
    t = {name: spark.read.parquet(f"{small}/{name}.parquet") for name in TABLES}
    days = t["orders"].select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").alias("day"))
    t["lineitem"] = t["lineitem"].join(days, "l_orderkey").withColumn(
        "l_shipdate", F.expr("day + make_dt_interval(l_linenumber)").cast("timestamp_ntz")
    ).select(*t["lineitem"].columns)
    shift = F.expr("make_dt_interval(1)") * F.datediff(F.lit("2001-01-01").cast("date"), F.to_date(F.lit("2024-01-10")))
    t["events"] = t["events"].withColumn("ts", (F.col("ts") + shift).cast("timestamp_ntz"))
    recent = t["orders"].where(F.col("o_orderdate") >= F.lit(SINCE))
    if later:
        first = t["lineitem"].join(recent, F.col("l_orderkey") == F.col("o_orderkey")).agg(
            F.min(F.struct("l_orderkey", "l_linenumber"))).first()[0]
        odd = (F.col("l_orderkey") == first[0]) & (F.col("l_linenumber") == first[1])
        t["lineitem"] = t["lineitem"].withColumn(
            "l_shipdate", F.when(odd, F.lit("1996-03-04").cast("timestamp_ntz")).otherwise(F.col("l_shipdate"))
        )
    else:
        # Some recent orders are not there yet, and a line of another one still had a year of its own.
        t["orders"] = t["orders"].where((F.col("o_orderdate") < F.lit(SINCE)) | (F.col("o_orderkey") % 2 == 0))
        last = recent.where("o_orderkey % 2 = 0").agg(F.max("o_orderkey")).first()[0]
        t["lineitem"] = t["lineitem"].join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey"), "left_semi").withColumn(
            "l_shipdate", F.when(F.col("l_orderkey") == last, F.lit("1990-01-02").cast("timestamp_ntz"))
            .otherwise(F.col("l_shipdate")))
        t["events"] = t["events"].where((F.col("ts") < F.lit(SINCE)) | (F.col("event_id") % 2 == 0))
    for name, df in t.items():
        df.write.parquet(os.path.join(folder, f"{name}.parquet"))
    return folder


def published(spark, where):
    root = publish_folder(spark, "increment")
    w = Warehouse(spark, where)
    for layer in DATA_LAYERS:
        w.publish_layer(layer, LAYERS[layer], root)
    return root


def year_files(root, layer, name):
    """Data files of each year of a published table."""
    path = os.path.join(root, layer, name)
    return {
        year: {f for f in os.listdir(os.path.join(path, year)) if f.endswith(".parquet")}
        for year in os.listdir(path) if year.startswith("year=")
    }


@pytest.fixture(scope="module")
def runs(spark, small, tmp_path_factory):
    before = source(spark, small, str(tmp_path_factory.mktemp("before")), False)
    after = source(spark, small, str(tmp_path_factory.mktemp("after")), True)
    root = published(spark, before)
    kept = {(l, n): year_files(root, l, n) for l in DATA_LAYERS for n in LAYERS[l] if n in YEAR_OF}
    touched = publish_since(Warehouse(spark, after), root, SINCE)
    return after, root, kept, touched


def test_touched_years(runs):
    touched = runs[3]
    assert (touched.first, touched.early) == (2001, (1990, 1996))


def test_second_run_equals_a_full_run(spark, runs):
    after, root, _, _ = runs
    opened, full = Warehouse.open(spark, after, root), Warehouse.open(spark, after, published(spark, after))
    for layer in DATA_LAYERS:
        for name in LAYERS[layer]:
            a, b = opened.table(name), full.table(name)
            assert sorted(a.columns) == sorted(b.columns), name
            rows = [sorted(map(str, df.select(*b.columns).collect())) for df in (a, b)]
            assert rows[0] == rows[1], name
    counts = [sorted(map(str, w.kept_counts(*DATA_LAYERS).collect())) for w in (opened, full)]
    assert counts[0] == counts[1]


def test_other_years_keep_their_files(runs):
    _, root, kept, touched = runs
    for (layer, name), before in kept.items():
        now = year_files(root, layer, name)
        for year in before.keys() & now.keys():
            text = year.removeprefix("year=")
            number = int(text) if text.isdigit() else 9999
            dates = number >= (touched.web if name == "fact_web_traffic" else touched.first)
            if not dates and number not in touched.early:
                assert now[year] == before[year], (name, year)
            if number == touched.first and name.startswith("fact_s"):
                assert not now[year] & before[year], (name, year)
    assert set(year_files(root, "fact", "fact_orders")) - {"year=2001"} == {f"year={y}" for y in range(1995, 2001)}


def test_a_year_without_rows_is_removed(runs):
    _, root, kept, _ = runs
    assert "year=1990" in kept["fact", "fact_shipments"]
    assert "year=1990" not in year_files(root, "fact", "fact_shipments")
    assert "year=1990" not in year_files(root, "processed", "order_items")


def test_a_session_over_new_year_brings_in_its_first_year(spark):
    def shop(events):
        web = spark.createDataFrame(events, "event_id long, ts string, visitor long, source string").withColumn(
            "ts", F.col("ts").cast("timestamp_ntz")).withColumn("event_date", F.to_date("ts"))
        lines = spark.createDataFrame([], "order_date date, ship_date date")
        w = Warehouse(spark, "unused")
        w.use("web_traffic", web)
        w.use("shipments", lines)
        return w

    old = [(1, "2000-12-31 23:50:00", None, "a"), (2, "2000-12-31 12:00:00", 8, "a")]
    new = [*old, (3, "2001-01-01 00:10:00", None, "b"), (4, "2001-01-01 12:00:00", 8, "b")]
    assert web_sessions(shop(new).table("web_traffic")).count() == 3
    assert touched_years(shop(new), shop(old), dt.date(2001, 1, 1)) == Touched(2001, (), 2000)
    assert touched_years(shop(old), shop(new), dt.date(2001, 1, 1)).web == 2000
    assert touched_years(shop(old), shop(old), dt.date(2001, 1, 1)).web == 2001
