"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# A line-level join followed by an aggregation on the same key is only split by AQE
# when it may add a shuffle; a hot order, product or customer needs that split.
SKEW_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app_name: str = "shelfcast", master: str | None = None, **conf: str) -> SparkSession:
    """A session with skew handling on; cluster sizing is left to spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        **SKEW_SETTINGS,
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_skew_settings(spark: SparkSession) -> None:
    """Turn AQE skew splitting on in a session this package did not create."""
    for key, value in SKEW_SETTINGS.items():
        spark.conf.set(key, value)


# Spark 4.1 and later; an older one ignores it, and keeps shuffle files until its cleaner comes.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_cleared(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of every job go when it ends. Else they stay until the driver collects its garbage, and
    those of all jobs lie on the disks together. For jobs that end in a write: a frame that is run again shuffles again."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


# Of stored and published files: money in whole numbers takes far less of the disk than under Spark's usual snappy.
CODEC = "zstd"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; where it is unset, a folder in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    return folder or os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "intermediate")


def publish_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared one, so that reruns never overwrite a reader's input."""
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


def durable(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that is read several times to the shared folder, and read it back.

    Spark reuses a shuffle only between identical subplans, and different columns or
    filters make them differ. So frames that a line-level pass produces are stored before
    ranks, forecast steps and iterative fits scan them again.
    """
    spark = df.sparkSession
    path = publish_folder(spark, name)
    df.write.option("compression", CODEC).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
