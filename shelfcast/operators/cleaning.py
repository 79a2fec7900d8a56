"""Standardising, deduplicating, filling and linking of raw tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.functions.exact import AMOUNT_DIGITS, code, fits, money


def clean_standardise(
    df: DataFrame, dates: Sequence[str] = (), codes: Sequence[str] = (),
    amounts: Sequence[str] | Mapping[str, int] = (), flags: bool = True,
) -> DataFrame:
    """DATE dates, trimmed upper-case codes (blank becomes NULL) and decimal amounts.

    ``amounts`` names the columns, or maps each to the digits it keeps after the point (two,
    unless said). A date or amount that cannot be read or does not fit becomes NULL and, with
    ``flags``, is marked in ``<column>_invalid``; an amount that had more digits than are kept is
    marked in ``<column>_rounded``. NaN is a missing amount, not an invalid one.
    """
    digits = dict(amounts) if isinstance(amounts, Mapping) else dict.fromkeys(amounts, AMOUNT_DIGITS)
    changed: dict[str, Column] = {name: F.col(name).try_cast("date") for name in dates}
    changed |= {name: code(name) for name in codes}
    changed |= {name: money(name, kept) for name, kept in digits.items()}
    kinds = dict(df.dtypes)
    if flags:
        for name in (*dates, *digits):
            present = F.col(name).isNotNull()
            if kinds[name] in ("double", "float"):
                present = present & ~F.isnan(name)
            changed[f"{name}_invalid"] = present & changed[name].isNull()
        for name in digits:
            changed[f"{name}_rounded"] = F.coalesce(_differs(name, kinds[name], changed[name]), F.lit(False))
    return df.withColumns(changed)


def _differs(name: str, kind: str, kept: Column) -> Column:
    """Whether the kept decimal is another number than the recorded one."""
    if kind in ("double", "float"):
        return kept.cast(kind) != F.col(name)
    wide = kept != F.col(name).try_cast("decimal(38,18)")
    return wide | (kept.cast("double") != F.col(name).try_cast("double"))


def clean_scale_profile(df: DataFrame, table_name: str, digits: Mapping[str, int], most: int = 8) -> DataFrame:
    """How many digits after the point the numbers of each column need, and whether they are kept.

    One row per column and number of digits (NULL: more than ``most``, or not finite) with the
    rows that need them; ``kept`` says whether ``digits`` of the column suffices. A missing
    number (NULL, NaN) needs none and is not counted. Each row becomes one cell per column and
    is counted on the map side, so a shuffle carries at most ``most`` + 2 rows per column and task.
    """
    cells = F.array(*[
        F.struct(
            F.lit(name).alias("column_name"),
            F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double")).alias("number"),
            F.lit(kept).alias("scale"),
        )
        for name, kept in digits.items()
    ])
    rows = df.select(F.explode(cells).alias("c")).select("c.*").where(F.col("number").isNotNull())
    infinite = F.abs("number") == F.lit(float("inf"))
    needed = F.when(infinite, F.lit(None).cast("int"))
    for d in range(most + 1):
        needed = needed.when(fits("number", d), F.lit(d))
    return rows.groupBy("column_name", "scale", needed.alias("digits")).agg(F.count("*").alias("row_count")).select(
        F.lit(table_name).alias("table_name"), "column_name", "digits", "scale",
        F.coalesce(F.col("digits") <= F.col("scale"), F.lit(False)).alias("kept"), "row_count",
    )


def clean_dedup(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by the other columns from left to right, NULL first.

    A minimum combines on the map side, so a key that repeats a billion times shuffles
    one row per task; a row_number window would sort them all in one task.
    """
    rest = [name for name in df.columns if name not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.min(F.struct(*rest)).alias("_first"))
        .select(*[F.col(name) if name in keys else F.col(f"_first.{name}") for name in df.columns])
    )


def clean_nulls(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Missing values (NULL or NaN) take the default; ``<column>_missing`` says where."""
    kinds = dict(df.dtypes)
    for name, default in defaults.items():
        missing = F.col(name).isNull()
        if kinds[name] in ("double", "float"):
            missing = missing | F.isnan(name)
        df = df.withColumn(f"{name}_missing", missing).withColumn(
            name, F.when(F.col(f"{name}_missing"), default).otherwise(F.col(name))
        )
    return df


@dataclass(frozen=True)
class Link:
    """Foreign key of a child table to the key of its parent."""

    name: str
    child: DataFrame
    child_key: str
    parent: DataFrame
    parent_key: str


def clean_link_check(links: Sequence[Link]) -> DataFrame:
    """Keys without a partner, in both directions, with the number of rows they stand for.

    Both sides are counted per key first, so a hot key reaches the join as one row, and one
    full outer join on that partitioning finds both kinds. A missing child key has no
    parent and is listed as NULL.
    """
    return reduce(DataFrame.unionByName, [_orphans(link) for link in links])


def _orphans(link: Link) -> DataFrame:
    child = link.child.groupBy(F.col(link.child_key).alias("orphan_key")).agg(F.count("*").alias("child_rows"))
    parent = link.parent.groupBy(F.col(link.parent_key).alias("orphan_key")).agg(F.count("*").alias("parent_rows"))
    joined = child.join(parent, "orphan_key", "full_outer")
    return joined.where(F.col("child_rows").isNull() | F.col("parent_rows").isNull()).select(
        F.lit(link.name).alias("relationship"),
        F.when(F.col("parent_rows").isNull(), "child_without_parent")
        .otherwise("parent_without_child")
        .alias("direction"),
        F.col("orphan_key").cast("string").alias("orphan_key"),
        F.coalesce("child_rows", "parent_rows").alias("row_count"),
    )
