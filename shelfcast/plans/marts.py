"""The nine business marts. Each reads facts at their own grain, sums them there and
joins only the sums, so no fact multiplies another."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from shelfcast.functions.calendar import month_start
from shelfcast.functions.exact import count_if, or_zero, ratio
from shelfcast.functions.ranking import rank_in_group
from shelfcast.operators.facts import profit_of_sums, summed
from shelfcast.operators.promotions import promo_days


def mart_sales_overview(sales_item: DataFrame) -> DataFrame:
    """Day x category x region. An order has one day and one customer, so counting the
    groups of (order, category) counts its orders without a second distinct."""
    per_order = sales_item.groupBy("order_id", "customer_id", "order_date", "category", "region").agg(
        *summed(("net", "cogs", "shipping_fee", "return_amount"))
    )
    return per_order.groupBy("order_date", "category", "region").agg(
        F.sum("net").alias("revenue"),
        profit_of_sums().alias("profit"),
        F.count("*").alias("orders"),
        F.countDistinct("customer_id").alias("customers"),
        F.sum("cogs").alias("cogs"),
        F.sum("return_amount").alias("return_amount"),
    )


def product_month(lines: DataFrame) -> DataFrame:
    return lines.groupBy("product_id", "category", month_start("order_date").alias("month")).agg(
        F.sum("units").alias("units"),
        F.sum("returned_units").alias("returned_units"),
        F.sum("net").alias("revenue"),
        profit_of_sums().alias("profit"),
    )


def mart_product_performance(monthly: DataFrame, reviews: DataFrame) -> DataFrame:
    """Product x order month, with the product's rating and its revenue rank in the category.

    ``monthly`` is read several times by the rank, so pass a stored ``product_month``.
    """
    ratings = reviews.groupBy("product_id").agg(ratio(F.sum("rating"), F.count("rating")).alias("mean_rating"))
    ranked = rank_in_group(monthly, ["category", "month"], "revenue", "rank_in_category")
    return ranked.join(ratings, "product_id", "left").select(
        "product_id", "category", "month", "units", "revenue", "profit",
        ratio("profit", "revenue").alias("margin"),
        ratio("returned_units", "units").alias("return_rate"),
        "mean_rating",
        F.col("rank_in_category").cast("bigint").alias("rank_in_category"),
    )


def mart_customer_insight(orders: DataFrame, customers: DataFrame, geography: DataFrame) -> DataFrame:
    """One row per customer with orders; recency counts from the last order day of all."""
    totals = orders.groupBy("customer_id").agg(
        F.count("*").alias("orders"),
        F.sum("net").alias("revenue"),
        profit_of_sums().alias("profit"),
        F.min("order_date").alias("first_order"),
        F.max("order_date").alias("last_order"),
        ratio(F.sum("returned_units"), F.sum("units")).alias("return_rate"),
    )
    last_day = orders.agg(F.max("order_date")).scalar()
    return (
        totals.join(customers.select("customer_id", "age_group", "nation_id"), "customer_id", "left")
        .join(geography.select("nation_id", "region"), "nation_id", "left")
        .select(
            "customer_id", "age_group", "region", "orders", "revenue", "profit", "first_order", "last_order",
            F.datediff(last_day, "last_order").alias("recency_days"), "return_rate",
        )
    )


def category_day(lines: DataFrame) -> DataFrame:
    return lines.groupBy(F.col("order_date").alias("date"), "category").agg(*summed(("net", "discount")))


def mart_promotion_effectiveness(daily: DataFrame, promotions: DataFrame) -> DataFrame:
    """Each promotion against the other days of its category.

    ``daily`` is a stored ``category_day``: sales shrink to it before they meet promotion
    days. Active days are the calendar days of its window within the span of all sales,
    sold or not; what lies outside a promotion is the category total minus what lies inside.
    """
    totals = daily.groupBy("category").agg(F.sum("net").alias("all_revenue"))
    span = daily.agg(F.min("date").alias("first_day"), F.max("date").alias("last_day")).select(F.struct("*")).scalar()
    last = F.least("end_date", span["last_day"])
    first = F.greatest("start_date", span["first_day"])
    inside = (
        promo_days(promotions)
        .join(daily, ["date", "category"])
        .groupBy("promo_id")
        .agg(
            F.sum("net").alias("revenue_inside"),
            F.sum("discount").alias("discount_amount"),
        )
    )
    joined = (
        promotions.select(
            "promo_id", "category", "discount_pct",
            F.greatest(F.datediff(last, first) + 1, F.lit(0)).cast("bigint").alias("active_days"),
            (F.datediff(span["last_day"], span["first_day"]) + 1).alias("all_days"),
        )
        .join(inside, "promo_id", "left")
        .join(totals, "category", "left")
    )
    joined = joined.withColumns({name: or_zero(joined, name) for name in ("revenue_inside", "discount_amount")})
    inside_rate = ratio("revenue_inside", "active_days")
    outside_rate = ratio(
        F.col("all_revenue") - F.col("revenue_inside"), F.col("all_days") - F.col("active_days")
    )
    return joined.select(
        "promo_id", "category", "discount_pct", "active_days", "revenue_inside", "discount_amount",
        inside_rate.alias("revenue_per_active_day"),
        outside_rate.alias("revenue_per_other_day"),
        (ratio(inside_rate, outside_rate) - 1).alias("lift"),
    )


def mart_return_diagnostics(sales_item: DataFrame) -> DataFrame:
    """Category x region x reason x month. Sold units come from the same pass: the window
    adds up the few reasons of a cell."""
    cell = ["category", "region", "month"]
    by_reason = sales_item.groupBy("category", "region", month_start("order_date").alias("month"), "return_reason").agg(
        F.sum("units").alias("units"),
        F.sum("return_amount").alias("return_amount"),
    )
    sold = F.sum("units").over(Window.partitionBy(*cell))
    return (
        by_reason.withColumn("sold", sold)
        .where(F.col("return_reason").isNotNull())
        .select(
            *cell, "return_reason", F.col("units").alias("returned_units"), "return_amount",
            ratio("units", "sold").alias("return_rate"),
        )
    )


def mart_shipping_service(sales_item: DataFrame) -> DataFrame:
    """Region x order month. Lines are counted per lead day first, so the exact
    percentiles read one row per distinct lead time."""
    lead = F.datediff("ship_date", "order_date")
    by_lead = sales_item.groupBy(
        "region", month_start("order_date").alias("month"), F.when(lead >= 0, lead).alias("lead_days")
    ).agg(
        F.count("*").alias("lines"), F.sum("shipping_fee").alias("shipping_fee"), F.sum("net").alias("net")
    )
    valid = F.when(F.col("lead_days").isNotNull(), F.col("lines"))
    return by_lead.groupBy("region", "month").agg(
        F.sum("lines").alias("lines"),
        ratio(F.coalesce(F.sum(valid), F.lit(0)), F.sum("lines")).alias("valid_share"),
        ratio(F.sum(F.col("lead_days") * F.col("lines")), F.sum(valid)).alias("mean_lead_days"),
        F.round(F.percentile("lead_days", 0.5, F.col("lines")), 6).alias("median_lead_days"),
        F.round(F.percentile("lead_days", 0.9, F.col("lines")), 6).alias("p90_lead_days"),
        F.sum("shipping_fee").alias("shipping_fee"),
        ratio(F.sum("shipping_fee"), F.sum("net")).alias("fee_share"),
    )


def mart_inventory_risk(snapshot: DataFrame) -> DataFrame:
    return snapshot.select(
        "product_id", "month", "fill_rate", "stockout", "overstock", "sell_through",
        F.when(F.col("stockout"), "stockout")
        .when(F.col("overstock"), "overstock")
        .otherwise("healthy")
        .alias("risk"),
    )


def monthly_inventory(snapshot: DataFrame) -> DataFrame:
    """Stock ratios of all products per month. The fill rate counts units, not products."""
    return snapshot.groupBy("month").agg(
        ratio(F.sum(F.least("demand", F.col("received"))), F.sum("demand")).alias("fill_rate"),
        ratio(count_if(F.col("stockout")), F.count("*")).alias("stockout_rate"),
        ratio(count_if(F.col("overstock")), F.count("*")).alias("overstock_rate"),
        ratio(F.sum("demand"), F.sum("received")).alias("sell_through"),
    )


def mart_operations(orders: DataFrame, sales_item: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Month: orders and cancellations, lead time of valid lines, returns and stock."""
    order_month = orders.groupBy(month_start("order_date").alias("month")).agg(
        F.count("*").alias("orders"), ratio(count_if(F.col("is_cancelled")), F.count("*")).alias("cancel_rate")
    )
    lead = F.datediff("ship_date", "order_date")
    line_month = sales_item.groupBy(month_start("order_date").alias("month")).agg(
        ratio(F.sum(F.when(lead >= 0, lead)), F.count(F.when(lead >= 0, 1))).alias("mean_lead_days"),
        ratio(F.sum("returned_units"), F.sum("units")).alias("return_rate"),
    )
    stock_month = monthly_inventory(snapshot).select("month", "fill_rate", "stockout_rate")
    return order_month.join(line_month, "month", "full_outer").join(stock_month, "month", "full_outer")
