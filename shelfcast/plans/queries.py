"""Every registered query: a name and a plan over the warehouse."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfcast.functions.calendar import calendar_parts
from shelfcast.functions.exact import AMOUNT_DIGITS, RATE_DIGITS, doubles, ratio
from shelfcast.operators import cleaning, facts, features, model, seasonal
from shelfcast.operators.seasonal import TARGETS
from shelfcast.plans import reports
from shelfcast.plans.warehouse import LAYERS, Warehouse
from shelfcast.session import apply_skew_settings, durable, publish_folder, shuffles_cleared
from shelfcast.sources.colocated import buckets_for, colocate, write_bucketed
from shelfcast.sources.publish import forecast_publish, submission_form
from shelfcast.sources.scan import TABLE_SCHEMAS, scan_typed

PREVIEW_ROWS = 10
NEUTRAL_RATING = 3
# Digits that each number of a raw line keeps.
LINE_DIGITS = {
    "l_quantity": AMOUNT_DIGITS, "l_extendedprice": AMOUNT_DIGITS, "l_discount": RATE_DIGITS, "l_tax": RATE_DIGITS,
}


def rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.withColumns({name: F.round(name, n) for name, n in digits.items()})


def _targets(pattern: str, digits: int) -> dict[str, int]:
    return {pattern.format(name): digits for name in TARGETS}


def _columns(*patterns: str) -> list[str]:
    return [pattern.format(name) for pattern in patterns for name in TARGETS]


# --- sources, inspection and the seasonal baseline -------------------------------------


def _scan_typed(w: Warehouse) -> DataFrame:
    return scan_typed(w.spark, f"{w.source}/orders.parquet", TABLE_SCHEMAS["orders"], ["o_orderdate"])


def _forecast_publish(w: Warehouse) -> DataFrame:
    path = publish_folder(w.spark, "submission")
    forecast_publish(_forecast(w), path)
    return scan_typed(w.spark, path, "Date string, Revenue double, COGS double", file_format="csv")


def _layer_publish(w: Warehouse) -> DataFrame:
    return w.publish_all(publish_folder(w.spark, "warehouse"))


def _annual(w: Warehouse) -> DataFrame:
    return seasonal.annual_totals(w.table("sales"))


def _growth_years(w: Warehouse) -> DataFrame:
    return seasonal.full_year_slice(
        _annual(w), w.window.first_growth_year, w.window.last_growth_year
    )


def _geo_mean_growth(w: Warehouse) -> DataFrame:
    growth = seasonal.geo_mean_growth(seasonal.yoy_change(_growth_years(w)))
    percent = growth.withColumns({f"{t}_growth_pct": (F.col(f"{t}_growth") - 1) * 100 for t in TARGETS})
    return rounded(percent, {**_targets("{}_growth", 9), **_targets("{}_growth_pct", 6)})


def _train(w: Warehouse) -> DataFrame:
    return w.table("sales").where(w.is_train())


def _normalised(w: Warehouse) -> DataFrame:
    return seasonal.year_mean_normalise(_train(w))


def _profile(w: Warehouse) -> DataFrame:
    return seasonal.seasonal_profile(_normalised(w))


def _seasonal_join(w: Warehouse) -> DataFrame:
    joined = seasonal.seasonal_join(w.horizon(), _profile(w))
    return rounded(joined.select("date", "month", "day", *_columns("{}_season")), _targets("{}_season", 9))


def _forecast(w: Warehouse) -> DataFrame:
    return seasonal.seasonal_forecast(w.stored("sales"), w.window)


def flagship(w: Warehouse) -> DataFrame:
    return _forecast(w).select("date", "years_ahead", *_columns("{}_pred"))


def _backcast(w: Warehouse) -> DataFrame:
    return seasonal.seasonal_backcast(w.stored("sales"), w.window)


def _mape(w: Warehouse) -> DataFrame:
    in_sample = seasonal.forecast_mape(_backcast(w)).withColumn("sample", F.lit("in_sample"))
    actual = w.stored("sales").where(~w.is_train())
    held_out = _forecast(w).select("date", *_columns("{}_pred")).join(actual, "date")
    hold_out = seasonal.forecast_mape(held_out).withColumn("sample", F.lit("hold_out"))
    return rounded(in_sample.unionByName(hold_out), _targets("{}_mape", 6))


SERIES_KEYS = ("category", "region")


def _forecast_by_key(w: Warehouse) -> DataFrame:
    return seasonal.seasonal_forecast(w.stored("keyed_series"), w.window, SERIES_KEYS).select(
        *SERIES_KEYS, "date", "years_ahead", *_columns("{}_pred")
    )


# --- cleaning ---------------------------------------------------------------------------


def _standardised_orders(w: Warehouse) -> DataFrame:
    return cleaning.clean_standardise(
        w.raw("orders"),
        dates=["o_orderdate"],
        codes=["o_orderstatus", "o_orderpriority"],
        amounts=["o_totalprice"],
    )


def _deduplicated_lines(w: Warehouse) -> DataFrame:
    lines = cleaning.clean_standardise(
        w.raw("lineitem"),
        dates=["l_shipdate"],
        codes=["l_returnflag", "l_linestatus"],
        amounts=LINE_DIGITS,
        flags=False,
    )
    return cleaning.clean_dedup(lines, ["l_orderkey", "l_linenumber"])


def _scale_profile(w: Warehouse) -> DataFrame:
    return cleaning.clean_scale_profile(w.raw("lineitem"), "lineitem", LINE_DIGITS)


def _filled_reviews(w: Warehouse) -> DataFrame:
    return cleaning.clean_nulls(w.table("reviews"), {"rating": F.lit(NEUTRAL_RATING)})


# --- features ---------------------------------------------------------------------------


def _all_days(w: Warehouse) -> DataFrame:
    return w.table("dim_date").select("date")


def _expected_mean(w: Warehouse) -> DataFrame:
    return features.feat_expected_mean(
        w.horizon(), w.table("daily_operations"), w.table("daily_inventory"), w.table("daily_traffic"),
        w.is_train(),
    )


def _expected_median(w: Warehouse) -> DataFrame:
    return features.feat_expected_median(w.horizon(), w.table("daily_operations"), w.is_train())


# --- model ------------------------------------------------------------------------------

def _trend_ridge(w: Warehouse) -> DataFrame:
    trended = model.trend_ridge(w.stored("sales"), w.is_train(), w.window.train_end)
    return rounded(trended.select("date", *_columns("{}_trend")), _targets("{}_trend", 2))


def _trend_huber(w: Warehouse) -> DataFrame:
    trended = model.trend_huber(w.stored("sales"), w.is_train(), w.window.train_end)
    return rounded(trended.select("date", *_columns("{}_trend")), _targets("{}_trend", 2))


def _trend_residual(w: Warehouse) -> DataFrame:
    residuals = model.trend_residual(w.stored("sales"), w.is_train(), w.window.train_end)
    return rounded(
        residuals.select("date", *_columns("{}_trend", "{}_residual")),
        {**_targets("{}_trend", 2), **_targets("{}_residual", 2)},
    )


def _hybrid(w: Warehouse) -> DataFrame:
    return w.hybrid_model().transform(model.model_frame(w.stored("mart_sales_forecast_ready")))


def _residual_gbt(w: Warehouse) -> DataFrame:
    return rounded(
        _hybrid(w).select("date", *_columns("{}_residual", "{}_residual_pred")),
        {**_targets("{}_residual", 2), **_targets("{}_residual_pred", 2)},
    )


def _hybrid_forecast(w: Warehouse) -> DataFrame:
    horizon = _hybrid(w).join(w.horizon(), "date", "left_semi")
    return submission_form(rounded(horizon, _targets("{}_pred", 2)))


def _folds(w: Warehouse, daily: DataFrame) -> DataFrame:
    return model.ts_cross_validation(daily, w.window.fold_years)


def _metrics(w: Warehouse) -> DataFrame:
    """Least-squares trend refitted in each fold and scored on the year after its cut."""
    folds = _folds(w, w.stored("sales"))
    trended = model.trend_ridge(folds, F.col("split") == "train", w.window.train_end, ["fold"])
    scored = trended.where(F.col("split") == "test").withColumns(
        {f"{t}_pred": F.col(f"{t}_trend") for t in TARGETS}
    )
    return rounded(model.forecast_metrics(scored, ["fold"]), {"rmse": 4, "mae": 4, "r2": 6})


DAILY_FRAMES = ("fact_sales_series", "promotions", "daily_operations", "daily_inventory", "daily_traffic")


def _hybrid_metrics(w: Warehouse) -> DataFrame:
    """The hybrid refitted in each fold, with either trend, scored on the year after its cut."""
    stop = f"{w.window.fold_years[-1] + 1}-01-01"
    frames = w.stored_together(DAILY_FRAMES)
    mart = features.mart_sales_forecast_ready(*frames, F.col("date") < F.lit(stop).cast("date"))
    metrics = model.hybrid_metrics(durable(mart, "folds-mart"), w.window.fold_years, ("ridge", "huber"))
    return rounded(metrics, {"rmse": 4, "mae": 4, "r2": 6})


def _order_line_shares(w: Warehouse) -> DataFrame:
    """Each line beside its order's sums. Lines are stored by order once, with no more than is asked for; then neither
    the sums nor the join move one. Rows of a key that repeats are repeated as in the facts."""
    with shuffles_cleared(w.spark):
        root = publish_folder(w.spark, "by-order")
        lines = w.line_amounts()
        buckets = buckets_for(w.table("lines").count())
        by_order = colocate(lines, os.path.join(root, "lines"), "order_id", buckets)
        headers = write_bucketed(w.order_headers(), os.path.join(root, "orders"), "order_id", buckets)
    return by_order.beside(facts.line_sums).join_one(headers).select(
        "order_id", "line_no", "status", "net", "order_net", "line_count", ratio("net", "order_net").alias("net_share")
    )


def _plain(name: str) -> Callable[[Warehouse], DataFrame]:
    return lambda w: w.table(name)


PLANS: dict[str, Callable[[Warehouse], DataFrame]] = {
    "scan_typed": _scan_typed,
    "forecast_publish": _forecast_publish,
    "layer_publish": _layer_publish,
    "frame_profile": lambda w: seasonal.frame_profile(
        {
            "train": w.stored("sales").where(w.is_train()),
            "horizon": w.horizon(),
            "forecast": _forecast(w).select("date", *_columns("{}_pred")),
        }
    ),
    "series_preview": lambda w: seasonal.series_preview(w.stored("sales"), PREVIEW_ROWS),
    "calendar_parts": lambda w: calendar_parts(w.table("sales")),
    "full_year_slice": _growth_years,
    "validation_filter": lambda w: seasonal.validation_filter(w.table("sales"), w.window.check_years),
    "annual_totals": _annual,
    "yoy_change": lambda w: rounded(seasonal.yoy_change(_growth_years(w)), _targets("{}_change", 9)),
    "geo_mean_growth": _geo_mean_growth,
    "year_mean_normalise": lambda w: rounded(
        _normalised(w).select("date", *_columns("{}", "{}_norm")), _targets("{}_norm", 9)
    ),
    "seasonal_profile": lambda w: rounded(_profile(w), _targets("{}_season", 9)),
    "base_level": lambda w: rounded(
        seasonal.base_level(_annual(w), w.window.base_year), _targets("{}_base", 6)
    ),
    "seasonal_join": _seasonal_join,
    "seasonal_forecast": flagship,
    "seasonal_backcast": lambda w: rounded(
        _backcast(w).select("date", "years_ahead", *_columns("{}", "{}_pred")), _targets("{}_pred", 4)
    ),
    "forecast_mape": _mape,
    "seasonal_forecast_by_key": _forecast_by_key,
    "clean_standardise": _standardised_orders,
    "clean_dedup": _deduplicated_lines,
    "clean_nulls": _filled_reviews,
    "clean_scale_profile": _scale_profile,
    "clean_link_check": _plain("link_check"),
    "quality_report": _plain("quality_report"),
    "processed_table_summary": _plain("processed_table_summary"),
    "table_inventory": _plain("table_inventory"),
    "sales_reconciliation": _plain("sales_reconciliation"),
    "rejected_lines": _plain("rejected_lines"),
    "visitors_by_month": _plain("visitors_by_month"),
    "customers_by_month": _plain("customers_by_month"),
    **{name: _plain(name) for layer in ("dim", "fact", "mart") for name in LAYERS[layer]},
    "order_line_shares": _order_line_shares,
    "report_business_overview": lambda w: reports.report_business_overview(w.table("fact_orders")),
    "report_profit_diagnostic": lambda w: reports.report_profit_diagnostic(
        w.table("fact_sales_item"), w.table("dim_promotion")
    ),
    "report_segment_insight": lambda w: reports.report_segment_insight(
        w.table("fact_sales_item"), w.table("fact_reviews")
    ),
    "report_segment_flags": lambda w: reports.report_segment_flags(
        reports.report_segment_insight(w.table("fact_sales_item"), w.table("fact_reviews"))
    ),
    "report_abnormal_growth": lambda w: reports.report_abnormal_growth(w.table("fact_orders")),
    "feat_calendar": lambda w: features.feat_calendar(_all_days(w)),
    "feat_season": lambda w: features.feat_season(_all_days(w)),
    "feat_sincos365": lambda w: features.feat_sincos365(_all_days(w)),
    "feat_promotion": lambda w: features.feat_promotion(_all_days(w), w.table("dim_promotion")),
    "feat_traffic": lambda w: features.feat_traffic(w.table("daily_traffic")),
    "feat_age_groups": lambda w: features.feat_age_groups(w.table("daily_operations")),
    "feat_cancel_rate": lambda w: features.feat_cancel_rate(w.table("daily_operations")),
    "feat_order_volume": lambda w: features.feat_order_volume(w.table("daily_operations")),
    "feat_inventory_health": lambda w: features.feat_inventory_health(w.table("daily_inventory")),
    "feat_business_diagnostic": lambda w: features.feat_business_diagnostic(w.table("daily_operations")),
    "feat_expected_mean": _expected_mean,
    "feat_expected_median": _expected_median,
    "trend_huber": _trend_huber,
    "trend_ridge": _trend_ridge,
    "trend_residual": _trend_residual,
    "residual_gbt": _residual_gbt,
    "hybrid_forecast": _hybrid_forecast,
    "ts_cross_validation": lambda w: _folds(w, w.table("sales")).select("fold", "date", "split"),
    "forecast_metrics": _metrics,
    "hybrid_metrics": _hybrid_metrics,
}


def run(name: str, spark: SparkSession, source: str) -> DataFrame:
    """One registered query, with decimals as DOUBLE. Turns skew handling on in the session."""
    apply_skew_settings(spark)
    return doubles(PLANS[name](Warehouse(spark, os.fspath(source))))
