"""Sinks: the forecast file and the warehouse layers."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, functions as F

from shelfcast.session import CODEC


def submission_form(forecast: DataFrame) -> DataFrame:
    """Date as yyyy-MM-dd text, Revenue, COGS."""
    return forecast.select(
        F.date_format("date", "yyyy-MM-dd").alias("Date"),
        F.col("revenue_pred").cast("double").alias("Revenue"),
        F.col("cogs_pred").cast("double").alias("COGS"),
    )


def forecast_publish(forecast: DataFrame, path: str) -> None:
    """CSV with a header and no index, in date order."""
    submission_form(forecast).orderBy("Date").write.option("header", True).csv(path)


# Rows of one file of a table without partitions.
FILE_ROWS = 5_000_000


def publish_table(df: DataFrame, path: str, year_of: str | None = None, date: str | None = None) -> dict:
    """Parquet; with ``year_of`` partitioned by the year of that date column. Returns the number of rows written and
    the span of ``date``, observed by the writing job itself.

    For a partitioned table the rebalance hint gathers each year before the write and lets AQE split a year that is too
    big for one file, so there are neither tiny files nor one giant task. Other tables are written as they come, cut
    into files of at most FILE_ROWS rows. Metrics are observed behind the last exchange, in the stage that writes, so
    a task that runs again is not counted twice.
    """
    none = F.lit(None).cast("date")
    metrics = (
        F.count(F.lit(1)).alias("row_count"),
        (F.min(date) if date else none).alias("first_date"),
        (F.max(date) if date else none).alias("last_date"),
    )
    seen = Observation()
    if year_of is None:
        writer = df.observe(seen, *metrics).write.mode("overwrite").option("compression", CODEC)
        writer.option("maxRecordsPerFile", FILE_ROWS).parquet(path)
    else:
        yearly = df if "year" in df.columns else df.withColumn("year", F.year(year_of))
        gathered = yearly.hint("rebalance", "year").observe(seen, *metrics)
        gathered.write.mode("overwrite").option("compression", CODEC).partitionBy("year").parquet(path)
    return seen.get


# Directory of the rows without a date.
NO_YEAR = "__HIVE_DEFAULT_PARTITION__"


def publish_years(df: DataFrame, path: str, year_of: str, held: Sequence[int | None]) -> None:
    """Replace years of a table that ``publish_table`` partitioned; other years keep their files.

    ``df`` holds all rows of the years it has any of. ``held`` are the years (None: no date) whose
    published rows are out of date; one of them that ``df`` has no row of is removed. The
    rows of each are counted by the writing job itself. A second run gives the same files.
    """
    spark = df.sparkSession
    yearly = df if "year" in df.columns else df.withColumn("year", F.year(year_of))
    seen = Observation()
    metrics = [F.count_if(F.col("year").eqNullSafe(F.lit(y))).alias(f"rows_{i}") for i, y in enumerate(held)]
    gathered = yearly.hint("rebalance", "year").observe(seen, F.count(F.lit(1)).alias("rows"), *metrics)
    writer = gathered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.option("compression", CODEC).partitionBy("year").parquet(path)
    counts = seen.get
    for i, year in enumerate(held):
        if not counts[f"rows_{i}"]:
            gone = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(path, f"year={NO_YEAR if year is None else year}"))
            gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)
