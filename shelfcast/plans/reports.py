"""Business reports: overview, profit diagnostic, segment insight, flags, abnormal growth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfcast.functions.calendar import month_start
from shelfcast.functions.exact import ratio
from shelfcast.operators.facts import profit_of_sums, summed
from shelfcast.operators.promotions import leading_promo

HIGH_RANK, LOW_RANK = 0.75, 0.25
GROWTH_HISTORY_MONTHS = 12
ABNORMAL_Z = 2.0
SEGMENT_SUMS = ("units", "returned_units", "net", "cogs", "shipping_fee", "return_amount")


def report_business_overview(orders: DataFrame) -> DataFrame:
    """Monthly trend from order totals; growth against the preceding month present. The
    unpartitioned window sees one row per month."""
    monthly = orders.groupBy(month_start("order_date").alias("month")).agg(
        F.sum("net").alias("revenue"),
        profit_of_sums().alias("profit"),
        F.count("*").alias("orders"),
        F.countDistinct("customer_id").alias("customers"),
        F.sum("cogs").alias("cogs"),
        F.sum("return_amount").alias("return_amount"),
    )
    by_month = Window.orderBy("month")
    growth = {
        f"{name}_growth": ratio(name, F.lag(name).over(by_month)) - 1
        for name in ("revenue", "profit", "orders")
    }
    return monthly.withColumns(growth)


def _level(sets: dict[str, str]) -> Column:
    """Name of the grouping set a row belongs to: the only column that is not rolled up."""
    label = F.lit("total")
    for column, name in sets.items():
        label = F.when(F.grouping(column) == 0, name).otherwise(label)
    return label


def report_profit_diagnostic(sales_item: DataFrame, promotions: DataFrame) -> DataFrame:
    """Cost components by promotion, by category, by region and in total.

    Lines shrink to day x category x region; the grouping sets then expand only that.
    """
    daily = sales_item.groupBy(F.col("order_date").alias("date"), "category", "region").agg(
        *summed(("gross", "net", "cogs", "shipping_fee", "return_amount"))
    )
    promo, category, region = F.col("promo_id"), F.col("category"), F.col("region")
    return (
        daily.join(leading_promo(promotions), ["date", "category"], "left")
        .groupingSets([[promo], [category], [region], []], promo, category, region)
        .agg(
            _level({"promo_id": "promotion", "category": "category", "region": "region"}).alias("level"),
            F.sum("net").alias("revenue"),
            F.sum("cogs").alias("cogs"),
            (F.sum("gross") - F.sum("net")).alias("discount"),
            F.sum("shipping_fee").alias("shipping_fee"),
            F.sum("return_amount").alias("return_amount"),
            profit_of_sums().alias("profit"),
            ratio(profit_of_sums(), F.sum("net")).alias("margin"),
        )
    )


def segment_sums(sales_item: DataFrame) -> DataFrame:
    """Sums per age group x category x region.

    ``category_orders`` counts (order, category) pairs and adds up over age groups and
    regions; ``orders`` counts each order once, at its first category, and adds up over
    categories. So no level needs a distinct count over all orders.
    """
    per_order = sales_item.groupBy("order_id", "age_group", "region", "category").agg(
        *summed(SEGMENT_SUMS)
    )
    one_order = Window.partitionBy("order_id").orderBy("category")
    return (
        per_order.withColumn("is_first", (F.row_number().over(one_order) == 1).cast("int"))
        .groupBy("age_group", "region", "category")
        .agg(
            *summed(SEGMENT_SUMS),
            F.count("*").alias("category_orders"),
            F.sum("is_first").alias("orders"),
        )
    )


def report_segment_insight(sales_item: DataFrame, reviews: DataFrame) -> DataFrame:
    """Age groups, categories and regions; ratings exist for categories only."""
    age, category, region = F.col("age_group"), F.col("category"), F.col("region")
    rating = reviews.groupBy("category").agg(ratio(F.sum("rating"), F.count("rating")).alias("category_rating"))
    segments = (
        segment_sums(sales_item)
        .groupingSets([[age], [category], [region]], age, category, region)
        .agg(
            _level({"age_group": "age_group", "category": "category", "region": "region"}).alias("segment_type"),
            F.sum("net").alias("revenue"),
            profit_of_sums().alias("profit"),
            ratio(profit_of_sums(), F.sum("net")).alias("margin"),
            F.when(F.grouping("category") == 0, F.sum("category_orders"))
            .otherwise(F.sum("orders"))
            .alias("orders"),
            ratio(F.sum("returned_units"), F.sum("units")).alias("return_rate"),
            ratio(F.sum("shipping_fee"), F.sum("net")).alias("shipping_fee_share"),
        )
    )
    return segments.join(rating, "category", "left").select(
        "segment_type",
        F.coalesce("age_group", "category", "region").alias("segment"),
        "revenue", "profit", "margin", "orders", "return_rate", "shipping_fee_share",
        F.col("category_rating").alias("mean_rating"),
    )


def report_segment_flags(segments: DataFrame) -> DataFrame:
    """Segments that stand out among their own kind (percent ranks)."""

    def rank(name: str) -> Column:
        return F.percent_rank().over(Window.partitionBy("segment_type").orderBy(F.col(name).asc_nulls_first()))

    return segments.withColumns(
        {
            "revenue_rank": rank("revenue"),
            "margin_rank": rank("margin"),
            "rating_rank": rank("mean_rating"),
            "return_rank": rank("return_rate"),
            "fee_rank": rank("shipping_fee_share"),
        }
    ).select(
        "segment_type",
        "segment",
        ((F.col("revenue_rank") >= HIGH_RANK) & (F.col("margin_rank") <= LOW_RANK)).alias("high_revenue_low_profit"),
        (
            F.col("mean_rating").isNotNull()
            & (F.col("rating_rank") >= HIGH_RANK)
            & (F.col("return_rank") >= HIGH_RANK)
        ).alias("good_rating_high_returns"),
        ((F.col("segment_type") == "region") & (F.col("fee_rank") >= HIGH_RANK)).alias("high_shipping_cost"),
    )


def report_abnormal_growth(orders: DataFrame) -> DataFrame:
    """Months whose revenue growth lies more than two deviations off the last 12 known growths.

    A month after one without revenue has no growth and is not part of the history. Where
    the history is flat, every other growth is abnormal; it has no z-score.
    """
    monthly = orders.groupBy(month_start("order_date").alias("month")).agg(F.sum("net").alias("revenue"))
    by_month = Window.orderBy("month")
    before = by_month.rowsBetween(-GROWTH_HISTORY_MONTHS, -1)
    growth = monthly.select(
        "month", "revenue", (ratio("revenue", F.lag("revenue").over(by_month)) - 1).alias("growth")
    )
    flat = F.max("growth").over(before) == F.min("growth").over(before)
    mean = F.avg("growth").over(before)
    z = F.when(~flat, F.try_divide(F.col("growth") - mean, F.stddev("growth").over(before)))
    return (
        growth.where(F.col("growth").isNotNull())
        .withColumns(
            {
                "z_score": z,
                "above": F.col("growth") > F.max("growth").over(before),
                "off_flat": flat & (F.col("growth") != F.max("growth").over(before)),
                "history": F.count("growth").over(before),
            }
        )
        .where((F.col("history") == GROWTH_HISTORY_MONTHS) & ((F.abs("z_score") > ABNORMAL_Z) | F.col("off_flat")))
        .select(
            "month",
            "revenue",
            "growth",
            F.round("z_score", 6).alias("z_score"),
            F.when(F.coalesce(F.col("z_score") > 0, F.col("above")), "growth").otherwise("decline").alias("direction"),
        )
    )
