"""Quality report, table summaries and the series reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.functions.exact import count_if, ratio


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


@dataclass(frozen=True)
class KeySet:
    """Rows of a frame to be counted by a key.

    ``when`` picks the rows, ``columns`` are the cells that should not be missing, ``bad`` is a date fault, ``sums`` are
    further amounts to add up, and ``kept`` are the key columns that stay when the counts are collapsed.
    """

    name: str
    keys: Sequence[str]
    kept: Sequence[str] = ()
    columns: Sequence[str] = ()
    when: Column | None = None
    bad: Column | None = None
    sums: Mapping[str, Column] = field(default_factory=dict)


def key_counts(df: DataFrame, sets: Sequence[KeySet]) -> DataFrame:
    """Counts by several keys in one pass: a row is expanded into one small struct per set, and all sets are grouped
    by one aggregation, which combines on the map side.

    Per set and kept key: ``row_count``, ``duplicate_rows`` (rows beyond the first of a whole key), ``null_cells``,
    ``bad_dates`` and the sums. Key columns that a set does not keep are NULL.
    """
    keys = list(dict.fromkeys(k for s in sets for k in s.keys))
    sums = {name: value for s in sets for name, value in s.sums.items()}
    kinds = dict(df.select(*[F.col(k) for k in keys], *[v.alias(f"_{n}") for n, v in sums.items()]).dtypes)

    def entry(number: int, s: KeySet) -> Column:
        missing = reduce(Column.__add__, [F.col(c).isNull().cast("int") for c in s.columns], F.lit(0))
        bad = F.coalesce(s.bad, F.lit(False)).cast("int") if s.bad is not None else F.lit(0)
        packed = F.struct(
            F.lit(number).alias("_set"),
            *[(F.col(k) if k in s.keys else F.lit(None).cast(kinds[k])).alias(k) for k in keys],
            missing.alias("_nulls"),
            bad.alias("_bad"),
            *[s.sums.get(n, F.lit(None)).cast(kinds[f"_{n}"]).alias(n) for n in sums],
        )
        return packed if s.when is None else F.when(s.when, packed)

    entries = F.explode(F.array(*[entry(i, s) for i, s in enumerate(sets)]))
    totals = [F.sum(name).alias(name) for name in sums]
    per_key = (
        df.select(entries.alias("_entry")).where("_entry is not null").select("_entry.*")
        .groupBy("_set", *keys)
        .agg(F.count("*").alias("n"), F.sum("_nulls").alias("nulls"), F.sum("_bad").alias("bad"), *totals)
    )
    kept_by = {k: [i for i, s in enumerate(sets) if k in s.kept] for k in keys}
    staying = [F.when(F.col("_set").isin(numbers), F.col(k)).alias(k) for k, numbers in kept_by.items() if numbers]
    name = F.element_at(F.array(*[F.lit(s.name) for s in sets]), F.col("_set") + 1)
    return (
        per_key.groupBy("_set", *staying)
        .agg(
            F.sum("n").alias("row_count"),
            F.sum(F.col("n") - 1).alias("duplicate_rows"),
            F.sum("nulls").alias("null_cells"),
            F.sum("bad").alias("bad_dates"),
            *totals,
        )
        .withColumn("set_name", name)
        .drop("_set")
    )


@dataclass(frozen=True)
class Reference:
    """Rows of the ``tables`` by foreign key (columns ``key`` and ``rows``; a key may come several times), and the
    table that should hold the keys."""

    tables: Sequence[str]
    children: DataFrame
    parent: str


MEASURES = ("row_count", "null_cells", "duplicate_rows", "orphan_rows", "bad_dates")


def _orphans(references: Sequence[Reference], parents: Mapping[str, DataFrame]) -> DataFrame:
    """Rows without a parent, per table. Children and parents of all references meet in one aggregation by key."""
    kinds = {dict(df.dtypes)["key"] for df in (*[r.children for r in references], *parents.values())}
    key = F.col("key").cast("bigint" if kinds <= {"int", "bigint"} else "string").alias("key")
    numbers = {name: i for i, name in enumerate(parents)}
    sides = [
        r.children.select(F.lit(numbers[r.parent]).alias("parent"), key, F.lit(i).alias("side"), "rows")
        for i, r in enumerate(references)
    ]
    sides += [
        keys.where("key is not null").select(
            F.lit(numbers[name]).alias("parent"), key, F.lit(-1).alias("side"), F.lit(1).cast("bigint").alias("rows")
        )
        for name, keys in parents.items()
    ]
    met = _union(sides).groupBy("parent", "key").agg(
        F.max(F.col("side") == -1).alias("known"),
        *[F.sum(F.when(F.col("side") == i, F.col("rows"))).alias(f"rows_{i}") for i in range(len(references))],
    )
    lost = met.where("not known").agg(
        F.array(
            *[
                F.struct(F.lit(name).alias("table_name"), F.coalesce(F.sum(f"rows_{i}"), F.lit(0)).alias("orphan_rows"))
                for i, r in enumerate(references)
                for name in r.tables
            ]
        ).alias("_lost")
    )
    return lost.select(F.explode("_lost").alias("_lost")).select("_lost.*")


def quality_report(
    tables: Sequence[str], counts: Sequence[DataFrame], references: Sequence[Reference],
    parents: Mapping[str, DataFrame],
) -> DataFrame:
    """Per table: rows, missing cells, repeated keys, rows without a parent, bad dates.

    ``counts`` are results of ``key_counts`` that hold a set named like each table. References are counted per key
    before they meet, so a hot key is a few rows; a missing foreign key has no parent.
    """
    own_measures = [m for m in MEASURES if m != "orphan_rows"]
    zero = F.lit(0).cast("bigint")
    none = [F.lit(name) for name in tables]
    empty = counts[0].sparkSession.range(1, numPartitions=1).select(
        F.explode(F.array(*none)).alias("table_name"), *[zero.alias(m) for m in MEASURES]
    )
    own = _union([c.where(F.col("set_name").isin(*tables)).select("set_name", *own_measures) for c in counts]).select(
        F.col("set_name").alias("table_name"),
        *[(zero if m == "orphan_rows" else F.col(m)).alias(m) for m in MEASURES],
    )
    lost = _orphans(references, parents).select(
        "table_name", *[(F.col(m) if m == "orphan_rows" else zero).alias(m) for m in MEASURES]
    )
    return _union([empty, own, lost]).groupBy("table_name").agg(*[F.sum(m).alias(m) for m in MEASURES])


def processed_table_summary(tables: Sequence[tuple[str, DataFrame, str | None]]) -> DataFrame:
    """Per table: rows, columns and the span of its date column."""
    none = F.lit(None).cast("date")
    return _union(
        [
            df.agg(
                F.count("*").alias("row_count"),
                (F.min(date_col) if date_col else none).alias("first_date"),
                (F.max(date_col) if date_col else none).alias("last_date"),
            ).select(
                F.lit(name).alias("table_name"),
                "row_count",
                F.lit(len(df.columns)).alias("column_count"),
                "first_date",
                "last_date",
            )
            for name, df, date_col in tables
        ]
    )


def table_inventory(tables: Sequence[tuple[str, str, DataFrame]]) -> DataFrame:
    """Per warehouse table: layer, rows and columns, counted. A published warehouse has
    counted them while it wrote (``counted_inventory``)."""
    return _union(
        [
            df.agg(F.count("*").alias("row_count")).select(
                F.lit(layer).alias("layer"),
                F.lit(name).alias("table_name"),
                "row_count",
                F.lit(len(df.columns)).alias("column_count"),
            )
            for layer, name, df in tables
        ]
    )


def counted_inventory(counts: DataFrame) -> DataFrame:
    """The inventory from the counts that publishing kept."""
    return counts.select("layer", "table_name", "row_count", "column_count")


def counted_summary(counts: DataFrame) -> DataFrame:
    """The summary of a layer from the counts that publishing kept."""
    return counts.select("table_name", "row_count", "column_count", "first_date", "last_date")


def sales_reconciliation(series: DataFrame, sales_lines: DataFrame) -> DataFrame:
    """Series revenue against line revenue by day; days known to one side only are kept."""
    lines = sales_lines.groupBy(F.col("order_date").alias("date")).agg(F.sum("net").alias("transaction_revenue"))
    joined = series.select("date", F.col("revenue").alias("series_revenue")).join(lines, "date", "full_outer")
    difference = F.coalesce("series_revenue", F.lit(0)) - F.coalesce("transaction_revenue", F.lit(0))
    return joined.select(
        "date",
        "series_revenue",
        "transaction_revenue",
        difference.alias("difference"),
        ratio(difference * 100, "series_revenue").alias("difference_pct"),
        F.when(F.col("series_revenue").isNull(), "series")
        .when(F.col("transaction_revenue").isNull(), "transactions")
        .otherwise("none")
        .alias("missing_side"),
    )
