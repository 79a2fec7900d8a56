"""Amounts and rates keep the digits that were recorded, and say where they cannot."""

import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfcast.functions.exact import Scaled, fits, money, whole
from shelfcast.operators import facts
from shelfcast.operators.cleaning import clean_scale_profile, clean_standardise
from shelfcast.plans import marts
from shelfcast.sources import roles

LINE = "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double, l_extendedprice double," \
    " l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"


def raw_lines(spark, rows):
    """(quantity, price, discount, tax) of one line each, all of one order and product."""
    text = LINE.replace("timestamp_ntz", "string")
    frame = spark.createDataFrame(
        [(1, i, 7, float(q), float(p), float(d), float(t), "R" if i % 2 else "N", "O", "2001-02-03 00:00:00")
         for i, (q, p, d, t) in enumerate(rows)], text,
    )
    return frame.withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp_ntz"))


def part(spark, price=2.25):
    frame = spark.createDataFrame([(7, "n", "b", "A", 3, price)], "p_partkey long, p_name string, p_brand string,"
                                  " p_type string, p_size int, p_retailprice double")
    return roles.stg_products(frame)


def test_an_eighth_is_exact_from_the_line_to_the_mart(spark):
    rows = [("3", "10.01", "0.125", "0.0375"), ("2", "99.99", "0.0001", "0.07"), ("1", "0.05", "1", "0")]
    items = roles.stg_items(roles.stg_lines(raw_lines(spark, rows)), part(spark))
    net, fee, off = (sum(Decimal(p) * f for (_, p, _, _), f in zip(rows, rates)) for rates in (
        [1 - Decimal(d) for _, _, d, _ in rows], [Decimal(t) for *_, t in rows], [Decimal(d) for _, _, d, _ in rows]))
    got = items.agg(*[F.sum(c).alias(c) for c in ("net", "shipping_fee", "discount", "cogs", "net_profit")]).first()
    returned = Decimal("99.99") * Decimal("0.9999")
    cogs = 6 * Decimal("2.25")
    assert (got["net"], got["shipping_fee"], got["discount"], got["cogs"]) == (net, fee, off, cogs)
    assert got["net_profit"] == net - cogs - fee - returned
    orders = spark.createDataFrame([(1, 5)], "order_id long, customer_id long").withColumns(
        {"order_date": F.lit("2001-01-31").cast("date"), "region": F.lit("E"), "status": F.lit("O"),
         "is_cancelled": F.lit(False)})
    overview = marts.mart_sales_overview(items.join(orders, "order_id")).first()
    assert (overview["revenue"], overview["return_amount"]) == (net, returned)
    payments = spark.createDataFrame([], "order_id long, payment_method string, payment_value decimal(12,2)")
    order = facts.fact_orders(orders, items, payments).first()
    assert (order["net"], order["shipping_fee"], order["gross"] - order["discount"]) == (net, fee, net)


def test_another_scale_is_followed_by_every_amount(spark):
    rows = [("1.234", "10.125", "0.0001234", "0.5")]
    lines = roles.stg_lines(raw_lines(spark, rows), amount_digits=3, rate_digits=7)
    item = roles.stg_items(lines, part(spark)).first()
    assert item["net"] == Decimal("10.125") * (1 - Decimal("0.0001234"))
    assert item["cogs"] == Decimal("1.234") * Decimal("2.25")
    stock = roles.stg_inventory(lines, part(spark)).first()
    assert stock["demand"] == Decimal("1.234")
    back = roles.stg_returns(lines.withColumn("is_returned", F.lit(True))).first()
    assert back["return_amount"] == item["net"]


def test_both_layers_round_alike(spark):
    values = [0.125, 1.005, -1.005, 2.675, 0.07, 1e9 + 0.015, 0.285, -0.125, 123456.785]
    rows = spark.createDataFrame([(v,) for v in values], "x double").select(
        money("x").alias("m"), Scaled(whole("x", 2), 2).decimal().alias("w"))
    for r in rows.collect():
        assert r["m"] == r["w"]


def test_numbers_without_a_value_or_beyond_a_long_are_null(spark):
    values = [None, math.nan, math.inf, -math.inf, 1e30, 1e300]
    got = spark.createDataFrame([(v,) for v in values], "x double").select(whole("x", 4).alias("w")).collect()
    assert [r["w"] for r in got] == [None] * 6


@pytest.mark.parametrize("digits", [0, 1, 2, 4, 6])
def test_fits_agrees_with_decimal_text(spark, digits):
    texts = [f"{a}.{b}" for a in (0, 3, 99999) for b in ("0", "1", "25", "07", "0625", "123456", "1234567", "3000000")]
    rows = spark.createDataFrame([(t, float(t)) for t in texts], "t string, x double")
    for r in rows.select("t", fits("x", digits).alias("ok")).collect():
        assert r["ok"] == (Decimal(r["t"]) == round(Decimal(r["t"]), digits)), r


def test_lost_digits_are_flagged(spark):
    df = spark.createDataFrame(
        [(0.125, "0.125", Decimal("0.12500"), 1.005), (0.12, "0.120", Decimal("0.12000"), 1e30),
         (math.nan, "x", None, None), (None, None, Decimal("7"), 0.0)],
        "a double, b string, c decimal(10,5), d double",
    )
    rows = clean_standardise(df, amounts=["a", "b", "c", "d"]).collect()
    assert [[r[f"{c}_rounded"] for c in "abcd"] for r in rows] == [
        [True, True, True, True], [False] * 4, [False] * 4, [False] * 4]
    assert [[r[f"{c}_invalid"] for c in "abcd"] for r in rows] == [
        [False] * 4, [False, False, False, True], [False, True, False, False], [False] * 4]
    kept = clean_standardise(df, amounts={"a": 4}).first()
    assert (kept["a"], kept["a_rounded"]) == (Decimal("0.1250"), False)


def test_scale_profile_counts_the_digits_that_are_needed(spark):
    values = [1.0, 2.5, 0.125, 0.125, 1 / 3, None, math.nan, math.inf, 1e30]
    df = spark.createDataFrame([(v, 1.0) for v in values], "x double, y double")
    got = {(r["column_name"], r["digits"]): (r["kept"], r["row_count"]) for r in
           clean_scale_profile(df, "t", {"x": 2, "y": 0}).collect()}
    assert got == {("x", 0): (True, 2), ("x", 1): (True, 1), ("x", 3): (False, 2), ("x", None): (False, 2),
                   ("y", 0): (True, 9)}
    assert clean_scale_profile(df.limit(0), "t", {"x": 2}).count() == 0
