"""Calendar columns of a date."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

# ISO weekdays that count as weekend (Friday, Saturday, Sunday).
WEEKEND_ISO_DAYS = (5, 6, 7)

# Season of each month.
SEASON_MONTHS = {
    "winter": (12, 1, 2),
    "spring": (3, 4, 5),
    "summer": (6, 7, 8),
    "autumn": (9, 10, 11),
}


def iso_weekday(date: Column | str) -> Column:
    """Monday is 1 and Sunday is 7."""
    return (F.weekday(date) + 1).cast("int")


def is_weekend(date: Column | str) -> Column:
    return iso_weekday(date).isin(*WEEKEND_ISO_DAYS)


def season(date: Column | str) -> Column:
    month = F.month(date)
    label = F.lit(None).cast("string")
    for name, months in SEASON_MONTHS.items():
        label = F.when(month.isin(*months), name).otherwise(label)
    return label


def month_start(date: Column | str) -> Column:
    return F.trunc(date, "month")


def year_angle(date: Column | str) -> Column:
    return F.lit(2.0 * math.pi) * F.dayofyear(date) / F.lit(365.0)


def calendar_parts(df: DataFrame, date_col: str = "date") -> DataFrame:
    """Adds year, day_of_year, month and day."""
    return df.withColumns(
        {
            "year": F.year(date_col),
            "day_of_year": F.dayofyear(date_col),
            "month": F.month(date_col),
            "day": F.dayofmonth(date_col),
        }
    )


def elapsed_micros(start: Column, end: Column) -> Column:
    """Microseconds between two zone-less timestamps, free of the session time zone."""
    gap = end - start
    days, hours, minutes, seconds = (
        F.extract(F.lit(part), gap) for part in ("DAY", "HOUR", "MINUTE", "SECOND")
    )
    whole = (days.cast("bigint") * 24 + hours) * 60 + minutes
    return whole * F.lit(60_000_000).cast("bigint") + (seconds * 1_000_000).cast("bigint")


def calendar_between(anchor: DataFrame, first: Column, last: Column) -> DataFrame:
    """One row per day between two scalar dates; ``anchor`` is a one-row frame."""
    return anchor.select(F.explode(F.sequence(first, last)).alias("date"))
