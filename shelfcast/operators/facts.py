"""The eight facts. Money stays DECIMAL here, so that every mart adds up exactly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.functions.exact import count_if, or_zero, ratio
from shelfcast.operators.dims import with_calendar

ORDER_SUMS = ("units", "returned_units", "gross", "net", "cogs", "shipping_fee", "return_amount")


def summed(names: Sequence[str]) -> list[Column]:
    return [F.sum(name).alias(name) for name in names]


def profit_of_sums() -> Column:
    """Net profit of a group from its sums: the same amount as summing it line by line,
    without computing it for each line."""
    return F.sum("net") - F.sum("cogs") - F.sum("shipping_fee") - F.sum("return_amount")


def sales_lines(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Order lines with their order's date and customer; lines without an order are
    in ``rejected_lines``."""
    return items.join(orders, "order_id")


def rejected_lines(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Order lines without an order. Facts leave them out; with these rows, the sums of the
    lines are whole again."""
    return items.join(orders.select("order_id"), "order_id", "left_anti").select(
        "order_id", "line_no", "product_id", "is_returned", "ship_date", "units", "gross", "discount", "net", "cogs",
        "shipping_fee", "return_amount", "net_profit",
    )


def order_payments(payments: DataFrame) -> DataFrame:
    """One row per order, so that a split payment cannot repeat order lines."""
    return payments.groupBy("order_id").agg(
        F.min("payment_method").alias("payment_method"), F.sum("payment_value").alias("payment_value")
    )


def fact_sales_item(
    items: DataFrame, orders: DataFrame, payments: DataFrame, customers: DataFrame, geography: DataFrame
) -> DataFrame:
    """Order line with order, customer, region and payment. The order side is completed
    first because it is the smaller one; the lines are joined once."""
    headers = (
        orders.join(order_payments(payments), "order_id", "left")
        .join(customers.select("customer_id", "age_group", "nation_id"), "customer_id", "left")
        .join(geography.select("nation_id", "region"), "nation_id", "left")
    )
    return sales_lines(items, headers).select(
        "order_id", "line_no", "product_id", "customer_id", "nation_id", "order_date", "ship_date", "status",
        "is_cancelled", "category", "age_group", "region", "payment_method",
        F.col("payment_value").alias("order_payment_value"),
        "units", "gross", "discount", "net", "cogs", "shipping_fee", "is_returned", "returned_units",
        "return_reason", "return_amount", "gross_profit", "net_profit",
    )


def order_sums(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(F.count("*").alias("line_count"), *summed(ORDER_SUMS))


def line_sums(lines: DataFrame) -> DataFrame:
    """``line_count`` and ``order_net`` of each order, as ``fact_orders`` has them."""
    sums = lines.groupBy("order_id").agg(F.count("*").alias("line_count"), F.sum("net").alias("order_net"))
    return sums.withColumn("order_net", or_zero(sums, "order_net"))


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """A row for every row whose key stands several times. A left join with them repeats rows just as one with the
    whole table does; since they are few as a rule, it need not move the other side once they are stored."""
    often = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    return often.select(key, F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("nth")).select(key)


def fact_orders(orders: DataFrame, items: DataFrame, payments: DataFrame) -> DataFrame:
    """One row per order, also for an order without lines. Lines are summed before the
    join, so a long order reaches it as one row."""
    joined = orders.join(order_sums(items), "order_id", "left").join(order_payments(payments), "order_id", "left")
    filled = joined.withColumns({name: or_zero(joined, name) for name in ORDER_SUMS})
    return filled.withColumns(
        {
            "line_count": F.coalesce("line_count", F.lit(0)).cast("bigint"),
            "discount": F.col("gross") - F.col("net"),
            "gross_profit": F.col("net") - F.col("cogs"),
            "net_profit": F.col("net") - F.col("cogs") - F.col("shipping_fee") - F.col("return_amount"),
        }
    ).select(
        "order_id", "customer_id", "order_date", "status", "is_cancelled", "payment_method", "payment_value",
        "line_count", "units", "returned_units", "gross", "discount", "net", "cogs", "shipping_fee", "return_amount",
        "gross_profit", "net_profit",
    )


def fact_shipments(shipments: DataFrame) -> DataFrame:
    return shipments.select(
        "order_id", "line_no", "order_date", "ship_date", "lead_days", "shipping_fee",
        (~F.col("is_valid")).alias("is_invalid_date"),
    )


def fact_returns(returns: DataFrame, orders: DataFrame, reasons: DataFrame) -> DataFrame:
    return (
        returns.join(orders.select("order_id", "customer_id", "order_date"), "order_id")
        .withColumnRenamed("reason", "return_reason")
        .join(reasons, "return_reason", "left")
        .select(
            "order_id", "product_id", "customer_id", "order_date", "return_reason_id", "return_reason", "units",
            "return_amount",
        )
    )


def fact_reviews(reviews: DataFrame, products: DataFrame) -> DataFrame:
    return reviews.join(products.select("product_id", "category"), "product_id", "left").select(
        "review_id", "product_id", "category", "rating", F.col("n_chars").alias("text_length")
    )


def fact_inventory_snapshot(inventory: DataFrame) -> DataFrame:
    return inventory.select(
        "product_id", "month", "demand", "received",
        F.greatest(F.col("received") - F.col("demand"), F.lit(0)).cast("decimal(22,2)").alias("available"),
        "fill_rate", "stockout", "overstock", "sell_through",
    )


def fact_sales_series(sales: DataFrame) -> DataFrame:
    """The daily series with calendar columns; it stays independent of the order lines."""
    return with_calendar(sales)


def fact_web_traffic(sessions: DataFrame, sources: DataFrame) -> DataFrame:
    """Day and source of the session start. No link to orders."""
    daily = sessions.groupBy("date", F.col("source").alias("traffic_source")).agg(
        F.count("*").alias("sessions"),
        F.countDistinct("visitor").alias("unique_visitors"),
        ratio(count_if(F.col("bounced")), F.count("*")).alias("bounce_rate"),
        ratio(F.sum("length_us") / F.lit(1e6), F.count("*")).alias("mean_session_seconds"),
    )
    return daily.join(sources, "traffic_source", "left").select(
        "date", "traffic_source_id", "traffic_source", "sessions", "unique_visitors", "bounce_rate",
        "mean_session_seconds",
    )
