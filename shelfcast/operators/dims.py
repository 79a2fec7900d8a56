"""The seven dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfcast.functions.calendar import calendar_between, is_weekend, iso_weekday, season
from shelfcast.functions.keys import stable_id


def dim_date(orders: DataFrame, web: DataFrame) -> DataFrame:
    """Every day from the first order to the last web event (or order)."""
    first = orders.agg(F.min("order_date").alias("first_day"), F.max("order_date").alias("last_order"))
    last_event = web.agg(F.to_date(F.max("ts"))).scalar()
    days = calendar_between(first, F.col("first_day"), F.greatest("last_order", last_event))
    return with_calendar(days)


def with_calendar(days: DataFrame) -> DataFrame:
    """The calendar columns of ``dim_date`` for any frame with a date."""
    return days.withColumns(
        {
            "year": F.year("date"),
            "quarter": F.quarter("date"),
            "month": F.month("date"),
            "day": F.dayofmonth("date"),
            "iso_weekday": iso_weekday("date"),
            "is_weekend": is_weekend("date"),
            "season": season("date"),
        }
    )


def dim_customer(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", "age_group", "nation_id")


def dim_product(products: DataFrame) -> DataFrame:
    return products.select("product_id", "name", "brand", "category", "size", "price")


def dim_geography(geography: DataFrame) -> DataFrame:
    return geography.select("nation_id", "nation", "region")


def dim_promotion(promotions: DataFrame) -> DataFrame:
    return promotions.select("promo_id", "start_date", "end_date", "discount_pct", "stackable", "category")


def _numbered(df: DataFrame, value: str, name: str) -> DataFrame:
    """Distinct codes with an id that depends on the code alone."""
    codes = df.where(F.col(value).isNotNull()).select(F.col(value).alias(name)).distinct()
    return codes.select(stable_id(name).alias(f"{name}_id"), name)


def dim_return_reason(returns: DataFrame) -> DataFrame:
    return _numbered(returns, "reason", "return_reason")


def dim_traffic_source(web: DataFrame) -> DataFrame:
    return _numbered(web, "source", "traffic_source")
