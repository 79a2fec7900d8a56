"""Tables stored by bucket of the order key."""

import re
import time

import pytest
from pyspark.sql import functions as F

from shelfcast.functions.exact import ratio
from shelfcast.plans import warehouse
from shelfcast.plans.queries import PLANS
from shelfcast.plans.warehouse import Warehouse
from shelfcast.session import durable, publish_folder, shuffles_cleared
from shelfcast.sources import roles
from shelfcast.sources.colocated import buckets_for, bucketed_files, colocate, write_bucketed
from test_plans import plan_of

LINES = "order_id bigint, line_no int, net decimal(18,2)"


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def frames(spark):
    lines = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 400).alias("order_id"),
        F.col("id").cast("int").alias("line_no"), (F.col("id") / 4).cast("decimal(18,2)").alias("net"),
    )
    lines = lines.unionByName(lines.where("line_no < 5"))  # repeated rows stay
    orders = spark.range(300).select(F.col("id").alias("order_id"), (F.col("id") * 2).alias("weight"))
    return lines, orders


@pytest.mark.parametrize("how", ["inner", "left"])
def test_same_rows_as_a_plain_join(spark, no_broadcast, how):
    lines, orders = frames(spark)
    root = publish_folder(spark, "colocated")
    stored = colocate(lines, f"{root}/lines", "order_id", 4, hot_rows=500)
    other = write_bucketed(orders, f"{root}/orders", "order_id", 4)
    assert [r["order_id"] for r in stored.hot.collect()] == [7]
    assert stored.near.where("order_id = 7 or order_id is null").count() == 0
    assert stored.all().count() == lines.count()
    got = stored.join_one(other, how)
    expected = lines.join(orders, "order_id", how)
    assert got.columns == expected.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


def test_no_line_moves(spark, no_broadcast):
    lines, orders = frames(spark)
    root = publish_folder(spark, "colocated")
    stored = colocate(lines, f"{root}/lines", "order_id", 4, hot_rows=500)
    other = write_bucketed(orders, f"{root}/orders", "order_id", 4)
    plan = plan_of(stored.near.join(other, "order_id"))
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    summed = plan_of(stored.near.groupBy("order_id").agg(F.sum("net")))
    assert "Exchange" not in summed
    other_session = spark.newSession()
    again = bucketed_files(other_session, f"{root}/lines/near", lines.schema, "order_id", 4)
    assert again.count() == stored.near.count()
    assert len(re.findall("Exchange", plan_of(again.groupBy("order_id").count()))) == 0


def test_column_metadata_and_empty_tables(spark):
    marked = spark.createDataFrame([], LINES).select(
        "order_id", F.col("line_no").alias("line_no", metadata={"scale": 3}), "net"
    )
    root = publish_folder(spark, "colocated")
    stored = colocate(marked, f"{root}/lines", "order_id", 2)
    assert stored.near.schema["line_no"].metadata == stored.apart.schema["line_no"].metadata == {"scale": 3}
    assert stored.join_one(spark.createDataFrame([(1, 2)], "order_id bigint, w int"), "left").count() == 0
    with pytest.raises(ValueError, match="full"):
        stored.join_one(marked, "full")


def test_number_of_buckets():
    assert [buckets_for(n, 10) for n in (0, 1, 10, 11, 20, 21, 41)] == [1, 1, 1, 2, 2, 4, 8]


def shop(spark):
    """A warehouse over rows of its own: keys repeat, are null, or stand in one table only."""
    raw = {
        "customer": ("c_custkey bigint, c_nationkey int, c_mktsegment string",
                     [(1, 1, "a"), (1, 2, "b"), (2, 2, "a"), (None, 1, "c")]),
        "region": ("r_regionkey int, r_name string", [(1, "north"), (1, "south")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(1, "x", 1), (2, "y", 2), (None, "z", 1)]),
        "part": ("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
                 [(5, "p", "b", "t", 1, 2.5), (5, "q", "b", "t", 1, 3.5), (6, "r", "b", "u", 1, 1.0), (None, "s", "b", "u", 1, 1.0)]),
        "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp, o_totalprice double, "
                   "o_orderpriority string",
                   [(k, c, s, None, 1.0, "p") for k, c, s in (
                       (10, 1, "O"), (10, 2, "F"), (11, 1, "P"), (12, None, "F"), (None, 2, "O"), (13, 9, None), (14, 2, "F"))]),
        "lineitem": ("l_orderkey bigint, l_linenumber int, l_partkey bigint, l_quantity double, l_extendedprice double, "
                     "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
                     [(k, n, p, 1.0, g, 0.25, 0.1, "N", "O", None) for n, (k, p, g) in enumerate((
                         (10, 5, 8.0), (10, 5, 8.0), (10, 6, 4.0), (11, 7, 3.0), (11, None, 2.0), (12, 5, None), (99, 5, 1.0),
                         (None, 5, 1.0), (13, 6, 0.0)))]),
    }
    frames = {name: spark.createDataFrame(rows, schema) for name, (schema, rows) in raw.items()}
    w = Warehouse(spark, "nowhere")
    for name, df in {
        "customers": roles.stg_customers(frames["customer"]),
        "geography": roles.stg_geography(frames["nation"], frames["region"]),
        "products": roles.stg_products(frames["part"]),
        "orders": roles.stg_orders(frames["orders"]),
        "payments": roles.stg_payments(frames["orders"]),
        "lines": roles.stg_lines(frames["lineitem"]),
    }.items():
        w.use(name, df, published=False)
    return w


@pytest.mark.parametrize("hot_rows", [1_000_000, 3])
def test_shares_of_lines_are_those_of_the_facts_and_store_no_fact(spark, monkeypatch, hot_rows):
    w, kept = shop(spark), []
    facts = w.table("fact_sales_item").select("order_id", "line_no", "status", "net").join(
        w.table("fact_orders").select("order_id", F.col("net").alias("order_net"), "line_count"), "order_id"
    )
    expected = facts.select(
        "order_id", "line_no", "status", "net", "order_net", "line_count", ratio("net", "order_net").alias("net_share")
    )
    monkeypatch.setattr(colocate, "__defaults__", (hot_rows,))
    monkeypatch.setattr(warehouse, "durable", lambda df, name: kept.append(df) or durable(df, name))
    got = PLANS["order_line_shares"](w)
    assert got.dtypes == expected.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
    assert got.count() > 20
    assert all(len(df.columns) == 1 for df in kept)  # keys that repeat, never a table of lines
    assert {tuple(df.columns) for df in kept} == {("product_id",), ("customer_id",), ("order_id",)}


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}


def test_shuffle_files_go_with_their_job(spark):
    key, before = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", shuffle_files(spark)
    held = spark.conf.get(key, None)
    with shuffles_cleared(spark):
        kept = durable(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "sevens")
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(key, None) == held
    assert sorted(r["count"] for r in kept.collect()) == [142, *[143] * 6]
