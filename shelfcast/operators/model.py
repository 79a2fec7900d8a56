"""Hybrid forecast: a linear trend plus boosted trees on its residuals."""

from __future__ import annotations

import os
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfcast.functions.calendar import SEASON_MONTHS
from shelfcast.functions.params import attach_params
from shelfcast.operators import features as feat
from shelfcast.operators.seasonal import DAYS_PER_YEAR, TARGETS
from shelfcast.session import durable

RIDGE_ALPHA = 1.0
# Fixed values of robust regression: the bend of the loss, and the median residual of a unit normal.
HUBER_EPSILON = 1.35
NORMAL_MEDIAN = 0.6745
HUBER_ROUNDS = 10
SEED = 42
# Models fitted at the same time.
FITS = 8
TREES, TREE_DEPTH, LEARNING_RATE = 20, 4, 0.1

MODEL_FEATURES = (
    "day_of_week", "day_of_month", "month", "quarter", "is_weekend", "sin365", "cos365",
    "active_promo_count", "max_discount_depth", "is_stackable_day", "traffic_is_imputed", "history_years",
    *(f"is_{name}" for name in SEASON_MONTHS),
    *(
        f"expected_{name}"
        for name in (
            *feat.TRAFFIC_FEATURES, *feat.AGE_FEATURES, *feat.ORDER_FEATURES, *feat.INVENTORY_FEATURES,
            *feat.DIAGNOSTIC_FEATURES,
        )
    ),
    *(f"median_{name}" for name in feat.MEDIAN_FEATURES),
)


def with_time(series: DataFrame, origin: str) -> DataFrame:
    """Adds ``t``, the years since the origin, and DOUBLE targets."""
    t = F.datediff("date", F.lit(origin).cast("date")) / F.lit(float(DAYS_PER_YEAR))
    return series.withColumns({"t": t, **{name: F.col(name).cast("double") for name in TARGETS}})


def ridge_params(train: DataFrame, keys: Sequence[str] = (), alpha: float = RIDGE_ALPHA) -> DataFrame:
    """Least squares with penalty ``alpha * slope^2`` and a free intercept, in one aggregation.

    With one regressor the solution is Sxy / (Sxx + alpha); alpha 0 is ordinary least squares.
    """
    fits = []
    for name in TARGETS:
        both = F.when(F.col(name).isNotNull(), F.col("t"))
        rows = F.count(both)
        sxy = F.covar_pop("t", name) * rows
        sxx = F.var_pop(both) * rows
        fits += [
            F.try_divide(sxy, sxx + F.lit(alpha)).alias(f"{name}_slope"),
            F.avg(both).alias(f"{name}_mean_t"),
            F.avg(name).alias(f"{name}_mean"),
        ]
    return train.groupBy(*keys).agg(*fits)


def apply_trend(
    days: DataFrame, params: DataFrame, keys: Sequence[str] = (), keep_params: bool = False
) -> DataFrame:
    fitted = attach_params(days, params, keys).withColumns(
        {
            f"{name}_trend": F.col(f"{name}_mean") + F.col(f"{name}_slope") * (F.col("t") - F.col(f"{name}_mean_t"))
            for name in TARGETS
        }
    )
    return fitted if keep_params else fitted.drop(*params.drop(*keys).columns)


def huber_params(
    train: DataFrame, keys: Sequence[str] = (), epsilon: float = HUBER_EPSILON, rounds: int = HUBER_ROUNDS
) -> DataFrame:
    """A robust line per key by iteratively reweighted least squares, ``rounds`` times from ordinary least squares.

    A residual within ``epsilon`` scales weighs 1, a larger one so much less that its pull stays that of ``epsilon``
    scales. The scale is the median absolute residual of the last round over that of a unit normal, so a round is one
    aggregation per key, whose parameters (a row per key) are stored; the first one only measures the scale. The
    correction is fitted to the residuals about the last centre, which keeps the sums well conditioned.
    """
    rows = durable(train.select(*keys, "t", *TARGETS), "huber-rows")
    unknown = {f"{name}_scale": F.lit(None).cast("double") for name in TARGETS}
    params = durable(ridge_params(rows, keys, alpha=0.0).withColumns(unknown), "huber-params")
    for _ in range(rounds + 1):
        away = apply_trend(rows, params, keys, keep_params=True)
        moved = []
        for name in TARGETS:
            r, bend = F.col(name) - F.col(f"{name}_trend"), F.lit(epsilon) * F.col(f"{name}_scale")
            weight = F.when(r.isNotNull(), F.when(F.abs(r) > bend, bend / F.abs(r)).otherwise(F.lit(1.0)))
            dt = F.when(r.isNotNull(), F.col("t") - F.col(f"{name}_mean_t"))
            n, st, sr = F.sum(weight), F.sum(weight * dt), F.sum(weight * r)
            stt, srt = F.sum(weight * dt * dt), F.sum(weight * dt * r)
            slope, mean_t, mean = (F.max(f"{name}_{part}") for part in ("slope", "mean_t", "mean"))
            turn = F.try_divide(srt - F.try_divide(st * sr, n), stt - F.try_divide(st * st, n))
            moved += [
                (slope + F.coalesce(turn, F.lit(0.0))).alias(f"{name}_slope"),
                (mean_t + F.try_divide(st, n)).alias(f"{name}_mean_t"),
                (mean + F.try_divide(slope * st + sr, n)).alias(f"{name}_mean"),
                (F.median(F.abs(r)) / F.lit(NORMAL_MEDIAN)).alias(f"{name}_scale"),
            ]
        params = durable(away.groupBy(*keys).agg(*moved), "huber-params")
    return params.drop(*unknown)


def trend_params(train: DataFrame, trend: str, keys: Sequence[str] = ()) -> DataFrame:
    return ridge_params(train, keys) if trend == "ridge" else huber_params(train, keys)


def trend_ridge(
    series: DataFrame, is_train: Column, origin: str, keys: Sequence[str] = (), alpha: float = RIDGE_ALPHA
) -> DataFrame:
    timed = with_time(series, origin)
    return apply_trend(timed, ridge_params(timed.where(is_train), keys, alpha), keys)


def trend_huber(
    series: DataFrame, is_train: Column, origin: str, keys: Sequence[str] = (), rounds: int = HUBER_ROUNDS
) -> DataFrame:
    """Robust trend per key."""
    timed = with_time(series, origin)
    return apply_trend(timed, huber_params(timed.where(is_train), keys, rounds=rounds), keys)


def trend_residual(series: DataFrame, is_train: Column, origin: str) -> DataFrame:
    """Actual minus the least-squares trend."""
    return with_residual(trend_ridge(series, is_train, origin, alpha=0.0))


def with_residual(trended: DataFrame) -> DataFrame:
    return trended.withColumns({f"{name}_residual": F.col(name) - F.col(f"{name}_trend") for name in TARGETS})


def model_frame(mart: DataFrame) -> DataFrame:
    """The forecast mart with one assembled feature vector. An expected value that no earlier training year gives is
    0 there; ``history_years`` and ``traffic_is_imputed`` tell the trees which these are."""
    seasons = mart.withColumns({f"is_{name}": (F.col("season") == name).cast("int") for name in SEASON_MONTHS})
    known = seasons.withColumns(
        {name: F.coalesce(name, F.lit(0.0)) for name in MODEL_FEATURES if name.startswith(("expected_", "median_"))}
    )
    numeric = known.withColumns(
        {name: F.col(name).cast("double") for name, kind in known.dtypes if kind == "boolean" and name != "is_train"}
    )
    assembler = VectorAssembler(inputCols=list(MODEL_FEATURES), outputCol="features")
    targets = [F.col(name).cast("double").alias(name) for name in TARGETS]
    return assembler.transform(numeric).select("date", "is_train", *targets, "features")


def fit_residual(train: DataFrame, target: str) -> GBTRegressionModel:
    """Trees on the residuals of one target. Each tree level is one aggregation of split statistics over the rows."""
    label = f"{target}_residual"
    trees = GBTRegressor(
        featuresCol="features", labelCol=label, predictionCol=f"{target}_residual_pred", seed=SEED,
        maxIter=TREES, maxDepth=TREE_DEPTH, stepSize=LEARNING_RATE,
    )
    return trees.fit(train.where(F.col(label).isNotNull()).select("features", label))


def with_forecast(predicted: DataFrame) -> DataFrame:
    return predicted.withColumns(
        {f"{name}_pred": F.col(f"{name}_trend") + F.col(f"{name}_residual_pred") for name in TARGETS}
    )


def _number(value: float | None) -> str:
    """A DOUBLE literal with all digits."""
    return "CAST(NULL AS DOUBLE)" if value is None else f"{value!r}D"


def _trend_stage(params: dict[str, float | None], origin: str) -> SQLTransformer:
    """Time, trend and residual as one statement, the fitted numbers written into it."""
    t = f"datediff(date, DATE'{origin}') / {float(DAYS_PER_YEAR)!r}D"
    columns = [f"{t} AS t"]
    for name in TARGETS:
        slope, mean_t, mean = (_number(params[f"{name}_{part}"]) for part in ("slope", "mean_t", "mean"))
        trend = f"({mean} + {slope} * ({t} - {mean_t}))"
        columns += [f"{trend} AS {name}_trend", f"{name} - {trend} AS {name}_residual"]
    return SQLTransformer(statement=f"SELECT *, {', '.join(columns)} FROM __THIS__")


def _sum_stage() -> SQLTransformer:
    sums = ", ".join(f"{name}_trend + {name}_residual_pred AS {name}_pred" for name in TARGETS)
    return SQLTransformer(statement=f"SELECT *, {sums} FROM __THIS__")


def fit_hybrid(mart: DataFrame, is_train: Column, origin: str, trend: str = "ridge") -> PipelineModel:
    """Trend and trees as one pipeline over ``model_frame``; what reaches the driver is six numbers of the trend."""
    frame = durable(model_frame(mart), "model-frame")
    params = trend_params(with_time(frame, origin).where(is_train), trend).first().asDict()
    first = _trend_stage(params, origin)
    train = first.transform(frame).where(is_train)
    with ThreadPoolExecutor(len(TARGETS)) as fits:
        trees = list(fits.map(lambda name: fit_residual(train, name), TARGETS))
    return PipelineModel([first, *trees, _sum_stage()])


def hybrid_predict(
    mart: DataFrame, is_train: Column, origin: str, trend: str = "ridge", model: PipelineModel | None = None
) -> DataFrame:
    """Trend plus predicted residual for every row of the mart, by ``model`` or by one fitted on the training rows."""
    return (model or fit_hybrid(mart, is_train, origin, trend)).transform(model_frame(mart))


def save_model(spark: SparkSession, model: PipelineModel, path: str, condition: dict[str, str]) -> None:
    """The pipeline, and beside it the condition that it was fitted under."""
    model.write().save(os.path.join(path, "pipeline"))
    named = spark.range(1, numPartitions=1).select(*[F.lit(value).alias(name) for name, value in condition.items()])
    named.write.parquet(os.path.join(path, "condition"))


def load_model(spark: SparkSession, path: str, condition: dict[str, str]) -> PipelineModel:
    """The pipeline kept at ``path``; one that was fitted under another condition is refused."""
    kept = spark.read.parquet(os.path.join(path, "condition")).first().asDict()
    if kept != condition:
        raise ValueError(f"the model at {path} was fitted under {kept}, not {condition}")
    return PipelineModel.load(os.path.join(path, "pipeline"))


def ts_cross_validation(daily: DataFrame, first_years: Sequence[int]) -> DataFrame:
    """Expanding folds: train before 1 January of the year, test within the year.

    Each daily row is copied to the folds it belongs to by an exploded literal array.
    """
    folds = F.array(
        *[
            F.struct(
                F.lit(number).alias("fold"),
                F.lit(f"{year}-01-01").cast("date").alias("cut"),
                F.lit(f"{year + 1}-01-01").cast("date").alias("stop"),
            )
            for number, year in enumerate(first_years, start=1)
        ]
    )
    return (
        daily.withColumn("_fold", F.explode(folds))
        .where(F.col("date") < F.col("_fold.stop"))
        .withColumn("fold", F.col("_fold.fold"))
        .withColumn("split", F.when(F.col("date") < F.col("_fold.cut"), "train").otherwise("test"))
        .drop("_fold")
    )


def forecast_metrics(scored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """RMSE, MAE and R2 per key and target; R2 is NULL when the actuals do not vary."""
    rows = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("target"),
                    F.col(name).cast("double").alias("actual"),
                    F.col(f"{name}_pred").alias("pred"),
                )
                for name in TARGETS
            ]
        )
    )
    long = (
        scored.select(*keys, rows.alias("_row"))
        .select(*keys, "_row.target", "_row.actual", "_row.pred")
        .where(F.col("actual").isNotNull() & F.col("pred").isNotNull())
    )
    error = F.col("actual") - F.col("pred")
    return long.groupBy(*keys, "target").agg(
        F.count("*").alias("row_count"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.try_divide(F.sum(error * error), F.var_pop("actual") * F.count("*"))).alias("r2"),
    )


def hybrid_metrics(mart: DataFrame, first_years: Sequence[int], trends: Sequence[str] = ("ridge",)) -> DataFrame:
    """RMSE, MAE and R2 of the hybrid per trend and expanding fold, all folds from one mart.

    ``mart`` holds every fold's days as training days. Its expected values come from years before each day's own;
    folds end with a year, so what a fold's training and test days know is the same in a mart of that fold alone.
    Trends are fitted with the fold as key; the trees of all folds, targets and trends are fitted side by side.
    """
    frame = model_frame(mart)
    folds = with_time(ts_cross_validation(frame, first_years), f"{first_years[-1]}-01-01")
    in_train = F.col("split") == "train"
    fitted = {}
    for trend in trends:
        trended = apply_trend(folds, trend_params(folds.where(in_train), trend, ["fold"]), ["fold"])
        fitted[trend] = durable(with_residual(trended), "folds")
    jobs = [(trend, fold, name) for trend in trends for fold in range(1, len(first_years) + 1) for name in TARGETS]

    def fit(job: tuple[str, int, str]) -> GBTRegressionModel:
        trend, fold, name = job
        return fit_residual(fitted[trend].where(in_train & (F.col("fold") == fold)), name)

    with ThreadPoolExecutor(FITS) as fits:
        trees = dict(zip(jobs, fits.map(fit, jobs)))
    scored = []
    for trend in trends:
        for fold in range(1, len(first_years) + 1):
            predicted = fitted[trend].where((F.col("split") == "test") & (F.col("fold") == fold))
            for name in TARGETS:
                predicted = trees[trend, fold, name].transform(predicted)
            scored.append(with_forecast(predicted).withColumn("trend", F.lit(trend)))
    columns = ["trend", "fold", *TARGETS, *[f"{name}_pred" for name in TARGETS]]
    return forecast_metrics(reduce(DataFrame.unionByName, [df.select(*columns) for df in scored]), ["trend", "fold"])
