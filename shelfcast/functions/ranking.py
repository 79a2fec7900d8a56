"""Exact ranks inside groups that are too big for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from shelfcast.functions.keys import null_safe_join

BAND_BITS = 20


def rank_in_group(df: DataFrame, keys: Sequence[str], value: str, name: str, scale: int = 4) -> DataFrame:
    """SQL ``rank()`` by ``value`` descending inside ``keys``, without a whole-group window.

    Values are fixed-point, so they become integers that split into bands of 2**20
    neighbouring values. Rows are first counted per distinct value, hence one sorting
    task holds at most 2**20 values however many rows tie or share a group. A rank is
    one plus the rows in higher bands plus the rows above inside the band. A NULL key is a
    group of its own. The window over the bands of a group sees its value range / 2**20.
    """
    keys = list(keys)
    amount = (F.col(value) * F.lit(10**scale)).cast("bigint")
    counted = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, amount.alias("_value"))
        .agg(F.count("*").alias("_rows"))
        .withColumn("_band", F.shiftright("_value", BAND_BITS))
    )
    higher_bands = Window.partitionBy(*keys).orderBy(F.desc("_band")).rowsBetween(Window.unboundedPreceding, -1)
    higher_values = (
        Window.partitionBy(*keys, "_band").orderBy(F.desc("_value")).rowsBetween(Window.unboundedPreceding, -1)
    )
    bands = (
        counted.groupBy(*keys, "_band")
        .agg(F.sum("_rows").alias("_rows"))
        .select(*keys, "_band", F.coalesce(F.sum("_rows").over(higher_bands), F.lit(0)).alias("_above"))
    )
    numbered = counted.withColumn("_ahead", F.coalesce(F.sum("_rows").over(higher_values), F.lit(0)))
    ranks = null_safe_join(numbered, bands, [*keys, "_band"], "inner").select(
        *keys, "_value", (F.col("_above") + F.col("_ahead") + 1).alias(name)
    )
    return null_safe_join(df.withColumn("_value", amount), ranks, [*keys, "_value"]).drop("_value")
