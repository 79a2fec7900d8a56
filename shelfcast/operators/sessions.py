"""Web sessions from raw page events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from shelfcast.functions.calendar import elapsed_micros

GAP_MINUTES = 30


def web_sessions(web: DataFrame, gap_minutes: int = GAP_MINUTES) -> DataFrame:
    """One row per session: visitor, start, end, events, source of the first event.

    A new session starts when more than the gap has passed since the last event. Events
    of one visitor inside a clock cell of the gap's length always belong together, so
    they are first folded into one row per visitor and cell, which combines on the map
    side. The window over a visitor then sees at most 48 rows per day, however many
    events a robot sends. Same result as ``session_window``, which would sort all events
    of a visitor in one task.
    """
    gap = f"{gap_minutes} minutes"
    cells = (
        web.groupBy("visitor", F.window("ts", gap).start.alias("cell"))
        .agg(
            F.min("ts").alias("first_ts"),
            F.max("ts").alias("last_ts"),
            F.count("*").alias("events"),
            F.min(F.struct("ts", "event_id", "source")).alias("opening"),
        )
    )
    by_time = Window.partitionBy("visitor").orderBy("cell")
    previous = F.lag("last_ts").over(by_time)
    starts = previous.isNull() | (F.col("first_ts") > previous + F.expr(f"INTERVAL {gap_minutes} MINUTES"))
    return (
        cells.withColumn("starts", starts.cast("int"))
        .withColumn("session_no", F.sum("starts").over(by_time))
        .groupBy("visitor", "session_no")
        .agg(
            F.min("first_ts").alias("start_ts"),
            F.max("last_ts").alias("end_ts"),
            F.sum("events").alias("events"),
            F.min("opening").alias("opening"),
        )
        .select(
            "visitor",
            "session_no",
            "start_ts",
            "end_ts",
            "events",
            F.col("opening.source").alias("source"),
            F.to_date("start_ts").alias("date"),
            elapsed_micros(F.col("start_ts"), F.col("end_ts")).alias("length_us"),
            (F.col("events") == 1).alias("bounced"),
        )
    )
