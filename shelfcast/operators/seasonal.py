"""Seasonal-profile-with-growth forecast of daily revenue and cost of goods.

Every operator takes ``keys``: with none it handles one series, with columns such as
("category", "region") it handles each combination in the same pass. A series frame has
one row per key and day, so a window over a year of one key sees at most 366 rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfcast.functions.calendar import calendar_parts
from shelfcast.functions.exact import ratio
from shelfcast.functions.keys import null_safe_join
from shelfcast.functions.params import attach_params

TARGETS = ("revenue", "cogs")
DAYS_PER_YEAR = 365


@dataclass(frozen=True)
class ForecastWindow:
    """``train_end`` is exclusive; growth years are inclusive; the horizon starts at ``train_end``."""

    train_end: str = "2001-01-01"
    first_growth_year: int = 1996
    last_growth_year: int = 2000
    base_year: int = 2000
    check_years: tuple[int, ...] = (1999, 2000)
    horizon_days: int = 548

    def is_train(self, date: str = "date") -> Column:
        return F.col(date) < F.lit(self.train_end).cast("date")

    @property
    def fold_years(self) -> tuple[int, ...]:
        """Years that cross-validation tests: the one that starts the horizon and the three before it."""
        last = int(self.train_end[:4])
        return tuple(range(last - 3, last + 1))


def annual_totals(series: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Yearly sum of each target; a year with only missing values counts as zero."""
    return (
        series.groupBy(*keys, F.year("date").alias("year"))
        .agg(*[F.sum(t).cast("double").alias(t) for t in TARGETS])
        .withColumns({t: F.coalesce(t, F.lit(0.0)) for t in TARGETS})
    )


def full_year_slice(annual: DataFrame, first: int, last: int) -> DataFrame:
    return annual.where(F.col("year").between(first, last))


def yoy_change(annual: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Change against the preceding year that is present, as a fraction; the first year drops out."""
    by_year = Window.partitionBy(*keys).orderBy("year")
    return (
        annual.withColumns({f"last_{t}": F.lag(t).over(by_year) for t in TARGETS})
        .where(F.col("last_revenue").isNotNull())
        .select(*keys, "year", *[(ratio(t, f"last_{t}") - 1).alias(f"{t}_change") for t in TARGETS])
    )


def geo_mean_growth(changes: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Geometric mean of one plus the changes. A change from zero is unknown and left out."""
    return changes.groupBy(*keys).agg(
        *[
            F.pow(
                F.product(1 + F.col(f"{t}_change")), F.try_divide(F.lit(1.0), F.count(f"{t}_change"))
            ).alias(f"{t}_growth")
            for t in TARGETS
        ]
    )


def year_mean_normalise(series: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Each target over the mean of its year; rows stay."""
    one_year = Window.partitionBy(*keys, "year")
    parts = calendar_parts(series)
    return parts.withColumns(
        {
            f"{t}_norm": ratio(t, ratio(F.sum(t).over(one_year), F.count(t).over(one_year)))
            for t in TARGETS
        }
    )


def seasonal_profile(normalised: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean normalised value of each calendar day, with names that cannot clash in a join."""
    return normalised.groupBy(*keys, "month", "day").agg(
        *[F.avg(f"{t}_norm").alias(f"{t}_season") for t in TARGETS]
    )


def base_level(annual: DataFrame, base_year: int, keys: Sequence[str] = ()) -> DataFrame:
    """Total of the last full year over 365, leap year or not."""
    return annual.where(F.col("year") == base_year).select(
        *keys, *[(F.col(t) / DAYS_PER_YEAR).alias(f"{t}_base") for t in TARGETS]
    )


def seasonal_join(days: DataFrame, profile: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Left join on the calendar day; a day unknown to the profile gets factor 1.

    The profile of one series has at most 366 rows and is broadcast. With keys it grows
    with them, so the choice is left to the size check of adaptive execution.
    """
    parts = calendar_parts(days)
    if keys:
        joined = null_safe_join(parts, profile, [*keys, "month", "day"])
    else:
        joined = parts.join(F.broadcast(profile), ["month", "day"], "left")
    return joined.withColumns({f"{t}_season": F.coalesce(f"{t}_season", F.lit(1.0)) for t in TARGETS})


@dataclass(frozen=True)
class SeasonalModel:
    profile: DataFrame
    growth: DataFrame
    base: DataFrame
    base_year: int
    keys: tuple[str, ...]

    def predict(self, days: DataFrame, digits: int | None = 2) -> DataFrame:
        """``base x growth^years_ahead x season``; NULL for a key without a base year."""
        seasoned = seasonal_join(days, self.profile, self.keys).withColumn(
            "years_ahead", F.col("year") - self.base_year
        )
        levelled = attach_params(attach_params(seasoned, self.growth, self.keys), self.base, self.keys)
        for t in TARGETS:
            value = F.col(f"{t}_base") * F.pow(f"{t}_growth", "years_ahead") * F.col(f"{t}_season")
            levelled = levelled.withColumn(f"{t}_pred", value if digits is None else F.round(value, digits))
        return levelled


def fit_seasonal(series: DataFrame, window: ForecastWindow, keys: Sequence[str] = ()) -> SeasonalModel:
    """Profile, growth and base from the rows before ``train_end``."""
    train = series.where(window.is_train())
    annual = annual_totals(train, keys)
    changes = yoy_change(full_year_slice(annual, window.first_growth_year, window.last_growth_year), keys)
    return SeasonalModel(
        profile=seasonal_profile(year_mean_normalise(train, keys), keys),
        growth=geo_mean_growth(changes, keys),
        base=base_level(annual, window.base_year, keys),
        base_year=window.base_year,
        keys=tuple(keys),
    )


def forecast_horizon(series: DataFrame, window: ForecastWindow, keys: Sequence[str] = ()) -> DataFrame:
    """Every calendar day of the horizon, for every key of the series, whether it sold or not."""
    first = F.lit(window.train_end).cast("date")
    days = F.sequence(first, F.date_add(first, window.horizon_days - 1))
    owners = series.select(*keys).distinct() if keys else series.sparkSession.range(1, numPartitions=1).select()
    return owners.select(*keys, F.explode(days).alias("date"))


def seasonal_forecast(
    series: DataFrame, window: ForecastWindow, keys: Sequence[str] = (), horizon: DataFrame | None = None
) -> DataFrame:
    """Forecast rounded to cents for ``horizon`` (keys and date; the window's calendar if left out)."""
    days = forecast_horizon(series, window, keys) if horizon is None else horizon.select(*keys, "date")
    return fit_seasonal(series, window, keys).predict(days)


def validation_filter(series: DataFrame, years: Sequence[int]) -> DataFrame:
    return series.where(F.year("date").isin(*years))


def seasonal_backcast(series: DataFrame, window: ForecastWindow, keys: Sequence[str] = ()) -> DataFrame:
    """The same formula on years the model was fitted on (negative years ahead), unrounded."""
    days = validation_filter(series, window.check_years)
    return fit_seasonal(series, window, keys).predict(days, digits=None)


def forecast_mape(scored: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean absolute percentage error per target; a zero actual has none and is left out."""
    return scored.groupBy(*keys).agg(
        *[
            (F.avg(ratio(F.abs(F.col(t).cast("double") - F.col(f"{t}_pred")), t)) * 100).alias(f"{t}_mape")
            for t in TARGETS
        ]
    )


def frame_profile(frames: dict[str, DataFrame], date_col: str = "date") -> DataFrame:
    """Rows, columns and date span of each frame."""
    parts = [
        df.agg(
            F.count("*").alias("row_count"), F.min(date_col).alias("first_date"), F.max(date_col).alias("last_date")
        ).select(
            F.lit(name).alias("frame"), "row_count", F.lit(len(df.columns)).alias("column_count"),
            "first_date", "last_date",
        )
        for name, df in frames.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def series_preview(series: DataFrame, rows: int) -> DataFrame:
    """First and last rows by date; Spark keeps only ``rows`` rows per task for each side."""
    head = series.orderBy("date").limit(rows).withColumn("side", F.lit("head"))
    tail = series.orderBy(F.desc("date")).limit(rows).withColumn("side", F.lit("tail"))
    return head.unionByName(tail)
