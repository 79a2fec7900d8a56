"""Joins and ids that hold for every key, NULL and new codes included."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on ``keys`` where NULL equals NULL; the key columns are those of the left side."""
    other = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(other, same, how).drop(*[f"_right_{k}" for k in keys])


def stable_id(code: str) -> Column:
    """A 60-bit id from the code's text alone, so a new code leaves all others' ids as they are."""
    return F.conv(F.substring(F.md5(F.col(code)), 1, 15), 16, 10).cast("bigint")
