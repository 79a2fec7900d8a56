"""Retail role tables (``stg_*``) built from the test tables.

Every other module reads the columns named here and nothing else, so a shop with its
own files only has to supply frames with these columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfcast.functions.calendar import month_start
from shelfcast.functions.exact import AMOUNT_DIGITS, RATE_DIGITS, Scaled, code, money, ratio, whole

# The role contract of promotions (days and percent).
PROMO_FIRST_OFFSET = 14
PROMO_EVERY = 50
PROMO_DAYS, PROMO_DAYS_STEP, PROMO_DAYS_CYCLE = 20, 15, 4
PROMO_PCT, PROMO_PCT_STEP, PROMO_PCT_CYCLE = 5, 5, 5
PROMO_STACKABLE_EVERY = 3
CANCELLED_STATUS = "P"
RETURNED_FLAG = "R"


def stg_orders(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("order_date"),
        code("o_orderstatus").alias("status"),
        (code("o_orderstatus") == CANCELLED_STATUS).alias("is_cancelled"),
    )


def stg_payments(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        code("o_orderpriority").alias("payment_method"),
        money("o_totalprice").alias("payment_value"),
    )


def stg_products(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("category"),
        F.col("p_size").alias("size"),
        money("p_retailprice").alias("price"),
    )


def stg_lines(
    lineitem: DataFrame, amount_digits: int = AMOUNT_DIGITS, rate_digits: int = RATE_DIGITS
) -> DataFrame:
    """Order lines as recorded, before any product is looked up; ``*_n`` are whole numbers, and
    the metadata of each says of which unit. ``clean_scale_profile`` shows the digits a table needs."""
    numbers = [
        Scaled(whole(source, digits), digits).named(name)
        for source, name, digits in (
            ("l_quantity", "units_n", amount_digits),
            ("l_extendedprice", "gross_n", amount_digits),
            ("l_discount", "discount_n", rate_digits),
            ("l_tax", "tax_n", rate_digits),
        )
    ]
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("product_id"),
        *numbers,
        (code("l_returnflag") == RETURNED_FLAG).alias("is_returned"),
        code("l_linestatus").alias("line_status"),
        F.to_date("l_shipdate").alias("ship_date"),
    )


def net_of(lines: DataFrame) -> Scaled:
    return Scaled.of(lines, "gross_n") * Scaled.of(lines, "discount_n").complement()


def _fee(lines: DataFrame) -> Scaled:
    return Scaled.of(lines, "gross_n") * Scaled.of(lines, "tax_n")


def stg_items(lines: DataFrame, products: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """Order lines with money columns, and the ``carried`` columns of line or product. A line
    of an unknown product is kept at no cost; the link check lists it."""
    prices = products.select(
        "product_id", "category", Scaled.of(products, "price").named("price_n"),
        *[c for c in carried if c not in lines.columns],
    )
    priced = lines.join(prices, "product_id", "left")
    units, gross = Scaled.of(priced, "units_n"), Scaled.of(priced, "gross_n")
    net, fee = net_of(priced), _fee(priced)
    cogs = (units * Scaled.of(priced, "price_n")).or_zero()
    returned = F.col("is_returned")
    return_amount = net.where(returned)
    return priced.select(
        "order_id",
        "line_no",
        "product_id",
        "category",
        units.decimal().alias("units"),
        gross.decimal().alias("gross"),
        (gross * Scaled.of(priced, "discount_n")).decimal().alias("discount"),
        net.decimal().alias("net"),
        cogs.decimal().alias("cogs"),
        fee.decimal().alias("shipping_fee"),
        "is_returned",
        units.where(returned).decimal().alias("returned_units"),
        F.when(returned, F.col("line_status")).alias("return_reason"),
        return_amount.decimal().alias("return_amount"),
        (net - cogs).decimal().alias("gross_profit"),
        (net - cogs - fee - return_amount).decimal().alias("net_profit"),
        "ship_date",
        *carried,
    )


def stg_customers(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_mktsegment").alias("age_group"),
        F.col("c_nationkey").alias("nation_id"),
    )


def stg_geography(nation: DataFrame, region: DataFrame) -> DataFrame:
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        F.col("n_nationkey").alias("nation_id"),
        F.col("n_name").alias("nation"),
        F.col("r_name").alias("region"),
    )


def stg_promotions(orders: DataFrame, part: DataFrame) -> DataFrame:
    """One promotion every 50 days over the order calendar, each for one product category.

    The categories take turns in name order; numbering them sorts the distinct names only.
    """
    names = part.where(F.col("p_type").isNotNull()).select(F.col("p_type").alias("category")).distinct()
    categories = names.select(
        "category",
        (F.row_number().over(Window.orderBy("category")) - 1).cast("bigint").alias("_no"),
    )
    many = names.agg(F.count("*")).scalar()
    span = orders.agg(
        F.to_date(F.min("o_orderdate")).alias("first_day"), F.to_date(F.max("o_orderdate")).alias("last_day")
    )
    last_no = F.floor((F.datediff("last_day", "first_day") - PROMO_FIRST_OFFSET) / F.lit(PROMO_EVERY)).cast("int")
    promo = F.col("promo_id")
    windows = (
        span.where(F.datediff("last_day", "first_day") >= PROMO_FIRST_OFFSET)
        .select("first_day", F.explode(F.sequence(F.lit(0), last_no)).alias("promo_id"))
        .select("promo_id", F.date_add("first_day", PROMO_FIRST_OFFSET + promo * PROMO_EVERY).alias("start_date"))
        .select(
            "promo_id",
            "start_date",
            F.date_add("start_date", PROMO_DAYS + PROMO_DAYS_STEP * (promo % PROMO_DAYS_CYCLE)).alias("end_date"),
            (PROMO_PCT + PROMO_PCT_STEP * (promo % PROMO_PCT_CYCLE)).alias("discount_pct"),
            (promo % PROMO_STACKABLE_EVERY == 0).alias("stackable"),
            F.try_mod(promo.cast("bigint"), many).alias("_no"),
        )
    )
    return windows.join(categories, "_no", "left").drop("_no")


def stg_shipments(lines: DataFrame, orders: DataFrame) -> DataFrame:
    return (
        lines.select(
            "order_id", "line_no", "ship_date", _fee(lines).decimal().alias("shipping_fee")
        )
        .join(orders.select("order_id", "order_date"), "order_id")
        .withColumn("lead_days", F.datediff("ship_date", "order_date"))
        .withColumn("is_valid", F.col("lead_days") >= 0)
    )


def stg_returns(lines: DataFrame) -> DataFrame:
    return lines.where("is_returned").select(
        "order_id",
        "product_id",
        Scaled.of(lines, "units_n").decimal().alias("units"),
        net_of(lines).decimal().alias("return_amount"),
        F.col("line_status").alias("reason"),
    )


def stg_reviews(documents: DataFrame, labels: DataFrame, part: DataFrame) -> DataFrame:
    product_count = part.agg(F.count("*")).scalar()
    return documents.select("doc_id", "n_chars").join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("review_id"),
        (F.col("doc_id") % product_count).cast("bigint").alias("product_id"),
        (1 + 3 * F.col("quality") + (1 - F.col("toxic"))).cast("int").alias("rating"),
        "n_chars",
    )


def stg_inventory(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Product-month stock. Lines are summed before the product join, so a hot product
    reaches the join with one row per month."""
    units = Scaled.of(lines, "units_n")
    demand = lines.groupBy("product_id", month_start("ship_date").alias("month")).agg(
        Scaled(F.sum(units.whole), units.digits).decimal().alias("demand")
    )
    return stock_of(demand, products)


def stock_of(demand: DataFrame, products: DataFrame) -> DataFrame:
    """Stock columns of the demand (product_id, month, demand) of product-months."""
    return (
        demand.join(products.select("product_id", "size"), "product_id", "left")
        .withColumn("received", (2 * F.col("size")).cast("bigint"))
        .select(
            "product_id",
            "month",
            "demand",
            "received",
            ratio(F.least("demand", F.col("received")), "demand").alias("fill_rate"),
            (F.col("demand") > F.col("received")).alias("stockout"),
            (F.col("received") > 2 * F.col("demand")).alias("overstock"),
            ratio("demand", "received").alias("sell_through"),
        )
    )


def stg_web(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id", "ts", F.col("user_id").alias("visitor"), F.col("event_type").alias("source")
    )


def stg_sales(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Daily series. Line cost is summed per order before the join, so a long order
    reaches it as one row; a day without lines has zero cost."""
    order_cost = items.groupBy("order_id").agg(F.sum("cogs").alias("cogs"))
    cost_digits = items.schema["cogs"].dataType.scale
    return (
        orders.select(
            F.col("o_orderkey").alias("order_id"),
            F.to_date("o_orderdate").alias("date"),
            money("o_totalprice").alias("revenue"),
        )
        .join(order_cost, "order_id", "left")
        .groupBy("date")
        .agg(
            F.sum("revenue").alias("revenue"),
            F.coalesce(F.sum("cogs"), F.lit(0)).cast(f"decimal(38,{cost_digits})").alias("cogs"),
        )
    )
