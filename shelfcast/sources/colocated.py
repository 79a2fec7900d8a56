"""Tables stored by bucket of a join key, so that their joins move no row of the long table."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from shelfcast.session import CODEC, durable

#: Rows of one bucket. The number of buckets is a power of two, so that tables of different sizes still meet.
BUCKET_ROWS = 5_000_000
#: A key with more rows than this is stored apart from the buckets.
HOT_ROWS = 1_000_000


def buckets_for(rows: int, bucket_rows: int = BUCKET_ROWS) -> int:
    return 1 << max(0, -(-rows // bucket_rows) - 1).bit_length()


@dataclass(frozen=True)
class Colocated:
    """``near``: rows in buckets of ``key``. ``apart``: rows without a key, and those of ``hot`` keys."""

    key: str
    near: DataFrame
    apart: DataFrame
    hot: DataFrame

    def all(self) -> DataFrame:
        return self.near.unionByName(self.apart)

    def beside(self, sums: Callable[[DataFrame], DataFrame]) -> Colocated:
        """Each row beside its key's row of ``sums``, which maps a frame to one row per key. All rows of a key lie in
        one of the two parts, so neither meets the sums of the other. Rows without a key go."""
        return replace(
            self, near=self.near.join(sums(self.near), self.key), apart=self.apart.join(sums(self.apart), self.key)
        )

    def join_one(self, other: DataFrame, how: str = "inner") -> DataFrame:
        """Join with a table that has one row per key, ``inner`` or ``left``.

        Where ``other`` is bucketed alike, the buckets meet as they lie. A hot key would make one
        bucket a third of the table; its rows were dealt out evenly, and meet the few rows of
        ``other`` that have a hot key (there are at most rows / HOT_ROWS), which Spark broadcasts
        or splits by their measured size.
        """
        if how not in ("inner", "left"):
            raise ValueError(f"{how} join would repeat rows of the other table")
        few = other.join(self.hot, self.key, "left_semi")
        return self.near.join(other, self.key, how).unionByName(self.apart.join(few, self.key, how))


def bucketed_files(spark: SparkSession, path: str, columns: T.StructType, key: str, buckets: int) -> DataFrame:
    """Read files that ``write_bucketed`` left, in any session: buckets are known to a catalog only.

    The entry is external; it can be dropped without harm to the files.
    """
    name = f"bucketed_{uuid.uuid4().hex}"
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
    where = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"create table {name} ({fields}) using parquet clustered by (`{key}`) sorted by (`{key}`) "
        f"into {buckets} buckets location '{where}'"
    )
    # A catalog keeps no metadata of columns, such as the digits of amounts.
    return spark.table(name).select(*[F.col(f"`{f.name}`").alias(f.name, metadata=f.metadata) for f in columns])


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """One file per bucket, sorted by the key: the exchange deals rows out as the buckets do."""
    name = f"bucketed_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, F.col(f"`{key}`")).write.format("parquet").option("path", path)
    writer = writer.option("compression", CODEC)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    df.sparkSession.sql(f"drop table {name}")  # the files stay
    return bucketed_files(df.sparkSession, path, df.schema, key, buckets)


def colocate(df: DataFrame, root: str, key: str, buckets: int, hot_rows: int = HOT_ROWS) -> Colocated:
    """Store a long table by key under ``root``. ``df`` is read three times, so it should be a stored table, or a scan
    of one.

    A table without rows gives empty parts; repeated rows stay. Rows without a key match nothing, and
    so are dealt out with the hot ones.
    """
    spark = df.sparkSession
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows_of_key"))
    hot = durable(counts.where(F.col("rows_of_key") > hot_rows).select(key), "hot-keys")
    near = write_bucketed(
        df.where(F.col(key).isNotNull()).join(hot, key, "left_anti").select(*df.columns),
        os.path.join(root, "near"), key, buckets,
    )
    apart = os.path.join(root, "apart")
    rest = df.where(F.col(key).isNull()).unionByName(df.join(hot, key, "left_semi").select(*df.columns))
    rest.write.option("compression", CODEC).parquet(apart)
    return Colocated(key, near, spark.read.schema(df.schema).parquet(apart), hot)
