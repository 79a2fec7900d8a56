"""Key counts and the report built on them, against plain Python."""

import datetime as dt
import random

from pyspark.sql import functions as F

from shelfcast.operators.quality import KeySet, Reference, key_counts, quality_report
from shelfcast.plans.warehouse import Warehouse

SCHEMA = "a long, b int, d date, x string, set_name string, n int"


def rows(seed, n=400):
    rng = random.Random(seed)
    out = [(7, rng.choice([1, 1, None]), dt.date(2000, 1, 1), "hot", "s", 1) for _ in range(n // 3)]
    for _ in range(n):
        day = rng.choice([None, dt.date(2000, 1, rng.randrange(1, 9))])
        out.append((rng.choice([None, *range(40)]), rng.randrange(5), day, rng.choice(["u", None]), "s", 1))
    return out


def brute(data, keys, columns, bad, keep):
    names = SCHEMA.replace(",", "").split()[::2]
    at = {n: i for i, n in enumerate(names)}
    groups = {}
    for r in filter(keep, data):
        groups.setdefault(tuple(r[at[k]] for k in keys), []).append(r)
    members = [r for g in groups.values() for r in g]
    return (
        len(members), len(members) - len(groups), sum(r[at[c]] is None for r in members for c in columns),
        sum(map(bad, members)),
    )


def test_key_counts_of_several_keys_in_one_pass(spark):
    data = rows(1)
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    sets = [
        KeySet("pair", ["a", "b"], (), ["a", "d", "x"], bad=F.col("d").isNull()),
        KeySet("some", ["d", "a"], ["a"], ["x"], when=F.col("x").isNotNull(), sums={"total": F.col("b")}),
        KeySet("one", ["b"], ["b"]),
    ]
    got = key_counts(df, sets).groupBy("set_name").agg(
        *[F.sum(c).alias(c) for c in ("row_count", "duplicate_rows", "null_cells", "bad_dates", "total")]
    ).collect()
    found = {r["set_name"]: tuple(r)[1:5] for r in got}
    assert found == {
        "pair": brute(data, ["a", "b"], ["a", "d", "x"], lambda r: r[2] is None, lambda r: True),
        "some": brute(data, ["d", "a"], ["x"], lambda r: False, lambda r: r[3] is not None),
        "one": brute(data, ["b"], [], lambda r: False, lambda r: True),
    }
    assert {r["set_name"]: r["total"] for r in got}["some"] == sum(r[1] or 0 for r in data if r[3] is not None)
    kept = {(r["set_name"], r["a"], r["b"]): r["row_count"] for r in key_counts(df, sets).collect()}
    assert kept["one", None, None] == sum(r[1] is None for r in data)
    assert kept["some", 7, None] == sum(r[0] == 7 and r[3] is not None for r in data)


def test_report_counts_orphans_and_keeps_empty_tables(spark):
    child = spark.createDataFrame([(1, 5), (1, 5), (2, 6), (3, None), (4, 9)], "id int, parent_id int")
    parent = spark.createDataFrame([(5,), (5,), (6,), (None,)], "parent_id long")
    counts = [
        key_counts(child, [KeySet("child", ["id"], (), ["id", "parent_id"]), KeySet("ref", ["parent_id"], ["parent_id"])]),
        key_counts(parent, [KeySet("parent", ["parent_id"], ["parent_id"], ["parent_id"])]),
        key_counts(child.limit(0), [KeySet("nothing", ["id"])]),
    ]
    children = counts[0].where("set_name = 'ref'").select(F.col("parent_id").alias("key"), F.col("row_count").alias("rows"))
    keys = counts[1].where("set_name = 'parent'").select(F.col("parent_id").alias("key"))
    report = quality_report(
        ["child", "parent", "nothing"], counts, [Reference(["child"], children, "parent")], {"parent": keys}
    )
    got = {r["table_name"]: tuple(r)[1:] for r in report.collect()}
    # rows, missing cells, repeated keys, orphans (the missing key and 9), bad dates
    assert got == {"child": (5, 1, 1, 2, 0), "parent": (4, 1, 1, 0, 0), "nothing": (0, 0, 0, 0, 0)}


def test_a_product_that_is_there_twice_repeats_lines_in_one_table_only(spark, small):
    w = Warehouse(spark, small)
    whole = {r["table_name"]: r.asDict() for r in w.table("quality_report").collect()}
    twice = Warehouse(spark, small)
    products = w.table("products")
    some = products.where("product_id % 10 = 0")
    twice._tables["products"] = products.unionByName(some)
    got = {r["table_name"]: r.asDict() for r in twice.table("quality_report").collect()}
    repeated = w.table("lines").join(some.select("product_id"), "product_id").count()
    assert got["products"]["duplicate_rows"] == some.count() > 0
    assert got["order_items"]["row_count"] == whole["order_items"]["row_count"] + repeated
    for table in ("returns", "shipments", "orders", "payments"):
        assert got[table] == whole[table]
    for table in got:
        assert got[table]["orphan_rows"] == whole[table]["orphan_rows"]
