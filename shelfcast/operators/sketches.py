"""Distinct counts that add up over time: mergeable sketches beside the exact counts."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Binary logarithm of the registers of a sketch.
LG_REGISTERS = 14
#: An estimate is given as right within so many of its standard errors.
STANDARD_ERRORS = 4


def stated_error(lg_registers: int = LG_REGISTERS) -> float:
    """Largest relative error that an estimate is given with."""
    return STANDARD_ERRORS * 1.04 / math.sqrt(2**lg_registers)


def distinct_sketches(
    df: DataFrame, keys: Sequence[str | Column], value: str, lg_registers: int = LG_REGISTERS
) -> DataFrame:
    """One row per key with a ``sketch`` of the different values (NULL is none).

    Sketches are filled on the map side, so a hot key shuffles at most one sketch (12 KB at
    2^14 registers, a few bytes for a few values) per task, never its values.
    """
    return df.groupBy(*keys).agg(F.hll_sketch_agg(value, lg_registers).alias("sketch"))


def rolled_up(sketches: DataFrame, keys: Sequence[str | Column], name: str) -> DataFrame:
    """Different values per coarser key, estimated from the sketches of the finer ones."""
    merged = sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("_merged"))
    return merged.withColumn(name, F.hll_sketch_estimate("_merged")).drop("_merged")


def within_error(estimate: str, exact: str, lg_registers: int = LG_REGISTERS) -> Column:
    """Whether an estimate keeps the stated error, to the next whole number."""
    allowed = F.ceil(F.col(exact) * F.lit(stated_error(lg_registers)))
    return F.abs(F.col(estimate) - F.col(exact)) <= allowed


def against_exact(
    df: DataFrame, sketches: DataFrame, keys: Sequence[str], value: str, name: str
) -> DataFrame:
    """Exact distinct counts per key, and whether the rolled-up sketches agree with them.

    Keys may be NULL. ``df`` is counted on its own, so the check does not rest on the sketches.
    """
    exact = df.groupBy(*keys).agg(F.countDistinct(value).alias(name))
    guess = rolled_up(sketches, [F.col(k).alias(f"_{k}") for k in keys], "_estimate")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    joined = exact.join(guess, same, "left")
    return joined.select(*keys, name, F.coalesce(within_error("_estimate", name), F.lit(False)).alias("within_error"))
