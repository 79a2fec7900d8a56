"""Daily features. Everything here has at most one row per calendar day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfcast.functions.calendar import is_weekend, month_start, season, year_angle
from shelfcast.functions.exact import count_if, ratio
from shelfcast.operators.promotions import daily_promo_signals

# The customer groups that play the age groups.
AGE_GROUPS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")

OTHER_AGES = "orders_other"
AGE_FEATURES = (*(f"orders_{group.lower()}" for group in AGE_GROUPS), OTHER_AGES)
ORDER_FEATURES = ("cancel_rate", "aov", "item_sold", "unique_order")
TRAFFIC_FEATURES = ("session_count", "mean_session_seconds", "unique_visitors", "bounce_rate")
INVENTORY_FEATURES = ("fill_rate", "stockout_rate", "overstock_rate", "sell_through")
DIAGNOSTIC_FEATURES = ("return_amount", "shipping_fee", "cogs", "profit")
MEDIAN_FEATURES = ("unique_order", "item_sold")


def feat_calendar(days: DataFrame) -> DataFrame:
    """``day_of_week`` counts from Monday = 0; the weekend is Friday to Sunday."""
    return days.withColumns(
        {
            "day_of_week": F.weekday("date"),
            "day_of_month": F.dayofmonth("date"),
            "month": F.month("date"),
            "quarter": F.quarter("date"),
            "is_weekend": is_weekend("date"),
        }
    )


def feat_season(days: DataFrame) -> DataFrame:
    return days.withColumn("season", season("date"))


def feat_sincos365(days: DataFrame) -> DataFrame:
    return days.withColumns(
        {
            "sin365": F.round(F.sin(year_angle("date")), 6),
            "cos365": F.round(F.cos(year_angle("date")), 6),
        }
    )


def feat_promotion(days: DataFrame, promotions: DataFrame) -> DataFrame:
    """Promotion signals; the calendar bounds their size, so they are broadcast."""
    joined = days.join(F.broadcast(daily_promo_signals(promotions)), "date", "left")
    return joined.withColumns(
        {
            "active_promo_count": F.coalesce("active_promo_count", F.lit(0)).cast("bigint"),
            "max_discount_depth": F.coalesce("max_discount_depth", F.lit(0)).cast("int"),
            "stacked_discount": F.coalesce("stacked_discount", F.lit(0)).cast("int"),
            "is_stackable_day": F.coalesce("is_stackable_day", F.lit(False)),
        }
    )


def daily_traffic(sessions: DataFrame) -> DataFrame:
    """Per day of the session start: both readings of "session" (count and mean length)."""
    return sessions.groupBy("date").agg(
        F.count("*").alias("session_count"),
        ratio(F.sum("length_us") / F.lit(1e6), F.count("*")).alias("mean_session_seconds"),
        F.countDistinct("visitor").alias("unique_visitors"),
        ratio(count_if(F.col("bounced")), F.count("*")).alias("bounce_rate"),
    )


def daily_operations(
    orders: DataFrame, customers: DataFrame, age_groups: Sequence[str] = AGE_GROUPS
) -> DataFrame:
    """All features that come from orders, in one pass over them.

    Each listed age group has a column; ``orders_other`` counts the orders of all other
    groups and of unknown customers, so the columns add up to ``unique_order``.
    """
    groups = {
        f"orders_{group.lower()}": count_if(F.coalesce(F.col("age_group") == group, F.lit(False)))
        for group in age_groups
    }
    groups[OTHER_AGES] = count_if(~F.coalesce(F.col("age_group").isin(*age_groups), F.lit(False)))
    return (
        orders.join(customers.select("customer_id", "age_group"), "customer_id", "left")
        .groupBy(F.col("order_date").alias("date"))
        .agg(
            F.count("*").alias("unique_order"),
            F.sum("units").cast("double").alias("item_sold"),
            ratio(F.sum("payment_value"), F.count("*")).alias("aov"),
            ratio(count_if(F.col("is_cancelled")), F.count("*")).alias("cancel_rate"),
            F.sum("return_amount").cast("double").alias("return_amount"),
            F.sum("shipping_fee").cast("double").alias("shipping_fee"),
            F.sum("cogs").cast("double").alias("cogs"),
            F.sum("net_profit").cast("double").alias("profit"),
            *[value.alias(name) for name, value in groups.items()],
        )
    )


def daily_inventory(dates: DataFrame, monthly: DataFrame) -> DataFrame:
    """The ratios of a month stand for each of its days."""
    return (
        dates.select("date", month_start("date").alias("month"))
        .join(monthly, "month")
        .select("date", *INVENTORY_FEATURES)
    )


def feat_traffic(traffic: DataFrame) -> DataFrame:
    return traffic.select("date", *TRAFFIC_FEATURES)


def feat_age_groups(operations: DataFrame) -> DataFrame:
    return operations.select("date", *AGE_FEATURES)


def feat_cancel_rate(operations: DataFrame) -> DataFrame:
    return operations.select("date", "cancel_rate")


def feat_order_volume(operations: DataFrame) -> DataFrame:
    return operations.select("date", "aov", "item_sold", "unique_order")


def feat_business_diagnostic(operations: DataFrame) -> DataFrame:
    return operations.select("date", *DIAGNOSTIC_FEATURES)


def feat_inventory_health(inventory: DataFrame) -> DataFrame:
    return inventory.select("date", *INVENTORY_FEATURES)


def _median(values: Column) -> Column:
    """Median of an array without NULLs; NULL for an empty one."""
    ordered, n = F.sort_array(values), F.size(values)
    low, high = F.floor((n + 1) / 2).cast("int"), F.floor(n / 2).cast("int") + 1
    return F.when(n > 0, (F.element_at(ordered, low) + F.element_at(ordered, high)) / 2)


def prior_expectation(daily: DataFrame, means: Sequence[str] = (), medians: Sequence[str] = ()) -> DataFrame:
    """``expected_<column>`` (mean) and ``median_<column>`` of a calendar day over the years of ``daily``
    up to and including ``after``, for each of its 366 calendar days and each of its years.

    ``daily`` must hold training days only, one row a day. A row is for days of the years behind ``after``, up to
    and including ``until`` (the next year of ``daily``; NULL: no end), so no day sees its own or a later year.
    ``history`` counts the years that have the calendar day; without any, the statistics are the means of the other
    calendar days' up to that year. There is one pass over ``daily``; all else sees 366 rows a year.
    """
    columns = list(dict.fromkeys((*means, *medians)))
    by_day = daily.groupBy(F.month("date").alias("month"), F.dayofmonth("date").alias("day")).agg(
        F.collect_list(F.struct(F.year("date").alias("year"), *columns)).alias("_rows")
    )
    leap_year = F.sequence(F.lit("2000-01-01").cast("date"), F.lit("2000-12-31").cast("date"))
    pairs = (
        daily.sparkSession.range(1, numPartitions=1)
        .select(F.explode(leap_year).alias("pair"))
        .select(F.month("pair").alias("month"), F.dayofmonth("pair").alias("day"))
    )
    everywhere = Window.partitionBy()
    years = F.flatten(F.collect_list(F.col("_rows.year")).over(everywhere))
    listed = pairs.join(by_day, ["month", "day"], "left").withColumn("_years", F.sort_array(F.array_distinct(years)))
    grid = listed.select("month", "day", "_rows", "_years", F.posexplode("_years").alias("_at", "after")).select(
        "month",
        "day",
        "after",
        F.try_element_at("_years", F.col("_at") + 2).alias("until"),
        F.try_element_at(F.filter("_rows", lambda row: row["year"] == F.col("after")), F.lit(1)).alias("_row"),
    )
    so_far = Window.partitionBy("month", "day").orderBy("after").rowsBetween(Window.unboundedPreceding, 0)
    stats = {f"expected_{c}": F.avg(F.col(f"_row.{c}")).over(so_far) for c in means}
    stats |= {f"median_{c}": _median(F.collect_list(F.col(f"_row.{c}").cast("double")).over(so_far)) for c in medians}
    known = grid.select(
        "month", "day", "after", "until", F.count("_row").over(so_far).alias("history"),
        *[stat.alias(name) for name, stat in stats.items()],
    )
    same_year = Window.partitionBy("after")
    return known.select(
        "month", "day", "after", "until", "history",
        *[F.round(F.coalesce(name, F.avg(name).over(same_year)), 6).alias(name) for name in stats],
    )


def on_calendar_day(days: DataFrame, expectation: DataFrame) -> DataFrame:
    """Expected values for dates, from earlier years alone. 366 rows a year are broadcast; a day matches at most one,
    and a day with no training year before its own has NULLs and no ``history``."""
    small = expectation.withColumnsRenamed({"month": "_month", "day": "_day", "after": "_after", "until": "_until"})
    same_day = (F.month("date") == F.col("_month")) & (F.dayofmonth("date") == F.col("_day"))
    year = F.year("date")
    in_reach = (year > F.col("_after")) & (F.col("_until").isNull() | (year <= F.col("_until")))
    joined = days.join(F.broadcast(small), same_day & in_reach, "left").drop("_month", "_day", "_after", "_until")
    return joined.withColumn("history", F.coalesce("history", F.lit(0)))


def expected_orders(days: DataFrame, operations: DataFrame, is_train: Column) -> DataFrame:
    """Expected order features, means and medians in one pass over the training days; ``history_years`` is the number
    of earlier training years that have the calendar day."""
    expectation = prior_expectation(
        operations.where(is_train), (*AGE_FEATURES, *ORDER_FEATURES, *DIAGNOSTIC_FEATURES), MEDIAN_FEATURES
    )
    return on_calendar_day(days, expectation).withColumnRenamed("history", "history_years")


def expected_inventory(days: DataFrame, inventory: DataFrame, is_train: Column) -> DataFrame:
    expectation = prior_expectation(inventory.where(is_train), INVENTORY_FEATURES)
    return on_calendar_day(days, expectation).drop("history")


def expected_traffic(days: DataFrame, traffic: DataFrame, is_train: Column) -> DataFrame:
    """Days whose calendar day had no traffic in an earlier training year are marked in ``traffic_is_imputed``; where
    no earlier training year had any, as in the test tables, their expected values are NULL."""
    joined = on_calendar_day(days, prior_expectation(traffic.where(is_train), TRAFFIC_FEATURES))
    return joined.withColumn("traffic_is_imputed", F.col("history") == 0).drop("history")


def feat_expected_mean(
    days: DataFrame, operations: DataFrame, inventory: DataFrame, traffic: DataFrame, is_train: Column
) -> DataFrame:
    """Mean of each operational feature on the same calendar day of all earlier training years."""
    orders = expected_orders(days, operations, is_train).drop(
        "history_years", *[f"median_{c}" for c in MEDIAN_FEATURES]
    )
    return expected_traffic(expected_inventory(orders, inventory, is_train), traffic, is_train)


def feat_expected_median(days: DataFrame, operations: DataFrame, is_train: Column) -> DataFrame:
    """Median orders and items on the same calendar day of all earlier training years."""
    return expected_orders(days, operations, is_train).select(
        *days.columns, *[f"median_{c}" for c in MEDIAN_FEATURES]
    )


def mart_sales_forecast_ready(
    series: DataFrame,
    promotions: DataFrame,
    operations: DataFrame,
    inventory: DataFrame,
    traffic: DataFrame,
    is_train: Column,
    horizon: DataFrame | None = None,
) -> DataFrame:
    """Targets and leak-free features per day of the series and of the horizon (its days
    without sales have NULL targets). Operational features enter as expected values on
    every day, from training years before the day's own, so a training row knows no more
    than a horizon row does; the first training year has no earlier one and knows NULLs.
    Each step adds columns to the same frame; the series is read once."""
    known = series.select("date", "revenue", "cogs")
    if horizon is not None:
        known = known.join(horizon.select("date"), "date", "full_outer")
    days = known.select("date", is_train.alias("is_train"), "revenue", "cogs")
    known_ahead = feat_promotion(feat_sincos365(feat_season(feat_calendar(days))), promotions)
    with_orders = expected_orders(known_ahead, operations, is_train)
    return expected_traffic(expected_inventory(with_orders, inventory, is_train), traffic, is_train)
