"""Promotion windows as days: the date-range join becomes an equi-join on the date."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def promo_days(promotions: DataFrame) -> DataFrame:
    """One row per promotion and active day, both ends included. The size is bounded by
    promotions times their length, not by sales."""
    return promotions.select(
        "promo_id", "discount_pct", "stackable", "category",
        F.explode(F.sequence("start_date", "end_date")).alias("date"),
    )


def daily_promo_signals(promotions: DataFrame) -> DataFrame:
    """Active promotions, deepest discount and stackability per day with any promotion.

    The discounts of stackable promotions add up (``stacked_discount``, as they are); the
    day's depth is that sum or the deepest of the others. A price cannot fall by more than
    100 percent, so the depth stops there.
    """
    return (
        promo_days(promotions)
        .groupBy("date")
        .agg(
            F.count("*").alias("active_promo_count"),
            F.max(F.when(~F.col("stackable"), F.col("discount_pct"))).alias("deepest"),
            F.sum(F.when(F.col("stackable"), F.col("discount_pct"))).alias("stacked"),
            F.max("stackable").alias("is_stackable_day"),
        )
        .select(
            "date",
            "active_promo_count",
            F.least(F.greatest(F.coalesce("stacked", F.lit(0)), F.coalesce("deepest", F.lit(0))), F.lit(100))
            .cast("int")
            .alias("max_discount_depth"),
            F.coalesce("stacked", F.lit(0)).cast("int").alias("stacked_discount"),
            "is_stackable_day",
        )
    )


def leading_promo(promotions: DataFrame) -> DataFrame:
    """The promotion a day's category sales are credited to: the deepest, then the lowest id."""
    return (
        promo_days(promotions)
        .groupBy("date", "category")
        .agg(F.max(F.struct("discount_pct", (-F.col("promo_id")).alias("rank_id"))).alias("lead"))
        .select("date", "category", (-F.col("lead.rank_id")).alias("promo_id"))
    )
