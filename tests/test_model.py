import datetime as dt
import random

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from shelfcast.operators import features, model
from shelfcast.plans import queries
from shelfcast.plans.queries import DAILY_FRAMES
from shelfcast.plans.warehouse import LAYERS, Warehouse
from shelfcast.session import durable, publish_folder

CUT = "2001-01-01"


def line_series(spark, noise, outliers=0, days=700, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(days):
        value = 1e6 + 500.0 * i + rng.gauss(0, noise)
        if outliers and i > days - 150 and i % outliers == 0:
            value *= 8
        rows.append((dt.date(1999, 6, 1) + dt.timedelta(i), value, value / 2))
    return spark.createDataFrame(rows, "date date, revenue double, cogs double")


def trained(df):
    return F.col("date") < F.lit(CUT).cast("date")


@pytest.mark.parametrize("alpha", [0.0, 1.0, 500.0])
def test_ridge_solves_the_penalised_problem(spark, alpha):
    series = line_series(spark, 2e5)
    rows = [r for r in model.with_time(series, CUT).orderBy("date").collect()]
    train = [r for r in rows if r["date"] < dt.date(2001, 1, 1)]
    x = np.array([[1.0, r["t"]] for r in train])
    y = np.array([r["revenue"] for r in train])
    centred = x[:, 1] - x[:, 1].mean()
    slope = np.linalg.solve([[centred @ centred + alpha]], [centred @ (y - y.mean())])[0]
    got = model.trend_ridge(series, trained(series), CUT, alpha=alpha).orderBy("date").collect()
    for r, g in zip(rows, got):
        assert g["revenue_trend"] == pytest.approx(y.mean() + slope * (r["t"] - x[:, 1].mean()), rel=1e-9)


def test_trends_per_key(spark):
    both = line_series(spark, 1e5).withColumn("k", F.lit("a")).unionByName(
        line_series(spark, 1e5, seed=9).withColumn("k", F.lit("b"))
    )
    keyed = model.trend_ridge(both, trained(both), CUT, ["k"])
    alone = line_series(spark, 1e5, seed=9)
    wanted = {r["date"]: r["revenue_trend"] for r in model.trend_ridge(alone, trained(alone), CUT).collect()}
    for r in keyed.where("k = 'b'").collect():
        assert r["revenue_trend"] == pytest.approx(wanted[r["date"]])


def test_huber_resists_outliers(spark):
    series = line_series(spark, 1e4, outliers=10)
    year = dt.timedelta(365)
    slopes = {}
    for name, fitted in (
        ("huber", model.trend_huber(series, trained(series), CUT)),
        ("ridge", model.trend_ridge(series, trained(series), CUT)),
    ):
        trend = {r["date"]: r["revenue_trend"] for r in fitted.collect()}
        first = dt.date(1999, 6, 1)
        slopes[name] = (trend[first + year] - trend[first]) / 365
    assert slopes["huber"] == pytest.approx(500, rel=0.1)
    assert slopes["ridge"] > 700


def test_trend_plus_residual_is_the_actual(spark, small):
    w = Warehouse(spark, small)
    for r in model.trend_residual(w.table("sales"), w.is_train(), w.window.train_end).collect():
        assert r["revenue_trend"] + r["revenue_residual"] == pytest.approx(r["revenue"])


def test_hybrid_beats_the_trend_on_training_days_and_is_stable(spark, small):
    w = Warehouse(spark, small)
    mart = w.stored("mart_sales_forecast_ready")
    assert not [c for c in model.MODEL_FEATURES if c not in mart.columns and not c.startswith("is_")]
    first, second = (
        {r["date"]: r for r in model.hybrid_predict(mart, w.is_train(), w.window.train_end).collect()} for _ in range(2)
    )
    assert {d: r["revenue_pred"] for d, r in first.items()} == {d: r["revenue_pred"] for d, r in second.items()}
    train = [r for d, r in first.items() if d < dt.date(2001, 1, 1)]
    for target in ("revenue", "cogs"):
        trend = sum((r[target] - r[f"{target}_trend"]) ** 2 for r in train)
        hybrid = sum((r[target] - r[f"{target}_pred"]) ** 2 for r in train)
        assert hybrid < trend
    assert len(first) == mart.count()


def test_the_hybrid_is_scored_on_unseen_years_with_both_trends(spark, small):
    w = Warehouse(spark, small)
    frames = w.stored_together(DAILY_FRAMES)
    mart = durable(features.mart_sales_forecast_ready(*frames, F.col("date") < F.lit("2002-01-01").cast("date")), "m")
    got = {(r["trend"], r["fold"], r["target"]): r for r in model.hybrid_metrics(mart, [2000, 2001], ("ridge", "huber")).collect()}
    assert set(got) == {(t, f, n) for t in ("ridge", "huber") for f in (1, 2) for n in ("revenue", "cogs")}
    for (_, fold, _), r in got.items():
        assert 0 < r["mae"] <= r["rmse"] and (r["row_count"] == 83 if fold == 2 else r["row_count"] > 50)


def test_one_mart_knows_in_each_fold_what_a_mart_of_that_fold_alone_knows(spark, small):
    w = Warehouse(spark, small)
    frames = w.stored_together(DAILY_FRAMES)

    def mart(stop):
        cut = F.lit(f"{stop}-01-01").cast("date")
        return features.mart_sales_forecast_ready(*frames, F.col("date") < cut)

    shared = mart(2002)
    for year in (1998, 2000):
        days = F.col("date") < F.lit(f"{year + 1}-01-01").cast("date")
        alone, common = mart(year).where(days).drop("is_train"), shared.where(days).drop("is_train")
        assert alone.count() == common.count() > 0
        assert alone.exceptAll(common).count() == 0


def test_a_day_never_sees_its_own_or_a_later_year(spark):
    """Spoiling a year leaves the expected values of that year and of those before it alone."""
    days = [dt.date(y, m, d) for y in range(1998, 2002) for m, d in ((1, 5), (2, 28), (7, 9))] + [dt.date(2000, 2, 29)]
    rng = random.Random(2)
    names = ["aov", *features.MEDIAN_FEATURES]

    def expected(spoiled):
        rows = [(d, *[1e9 if d.year >= spoiled else float(rng_of[d] + i) for i in range(len(names))]) for d in days]
        daily = spark.createDataFrame(rows, "date date, " + ", ".join(f"{n} double" for n in names))
        frame = spark.createDataFrame([(d,) for d in days], "date date")
        stats = features.prior_expectation(daily, names, features.MEDIAN_FEATURES)
        return {r["date"]: r.asDict() for r in features.on_calendar_day(frame, stats).collect()}

    rng_of = {d: rng.randrange(100) for d in days}
    clean = expected(9999)
    for year in (1999, 2000, 2001):
        spoiled = expected(year)
        assert [spoiled[d] for d in days if d.year <= year] == [clean[d] for d in days if d.year <= year]
    for d in days:
        earlier = [rng_of[e] for e in days if (e.month, e.day) == (d.month, d.day) and e.year < d.year]
        assert clean[d]["history"] == len(earlier)
        if earlier:
            assert clean[d]["expected_aov"] == pytest.approx(np.mean(earlier), abs=1e-6)
            assert clean[d]["median_unique_order"] == pytest.approx(np.median(earlier) + 1, abs=1e-6)
        elif d.year == 1998:
            assert clean[d]["expected_aov"] is None
    leap = clean[dt.date(2000, 2, 29)]  # no earlier 29 February: the mean over the calendar days known by then
    known = [np.mean([rng_of[dt.date(y, m, d)] for y in (1998, 1999)]) for m, d in ((1, 5), (2, 28), (7, 9))]
    assert leap["expected_aov"] == pytest.approx(np.mean(known), abs=1e-6)


def test_expected_traffic_knows_training_days_only(spark):
    traffic = spark.createDataFrame(
        [(dt.date(2000, 3, 1), 10, 1.0, 1, 0.5), (dt.date(2001, 3, 1), 1000, 1.0, 1, 0.5)],
        "date date, session_count long, mean_session_seconds double, unique_visitors long, bounce_rate double",
    )
    days = spark.createDataFrame([(dt.date(2000, 3, 1),), (dt.date(2001, 3, 1),), (dt.date(2002, 3, 1),)], "date date")
    got = {
        r["date"].year: (r["expected_session_count"], r["traffic_is_imputed"])
        for r in features.expected_traffic(days, traffic, trained(traffic)).collect()
    }
    assert got == {2000: (None, True), 2001: (10.0, False), 2002: (10.0, False)}
    late = features.expected_traffic(days, traffic, F.col("date") < F.lit("1999-01-01").cast("date")).collect()
    assert {(r["expected_session_count"], r["traffic_is_imputed"]) for r in late} == {(None, True)}


def huber_by_hand(t, y, rounds=model.HUBER_ROUNDS):
    """The rounds with numpy's weighted least squares, the scale lagging one round."""
    x = np.column_stack([np.ones_like(t), t])
    beta = np.linalg.lstsq(x, y, rcond=None)[0]
    scale = None
    for _ in range(rounds + 1):
        r = y - x @ beta
        w = np.ones_like(r) if scale is None else np.minimum(1, model.HUBER_EPSILON * scale / np.maximum(np.abs(r), 1e-300))
        scale = np.median(np.abs(r)) / model.NORMAL_MEDIAN
        root = np.sqrt(w)
        beta = np.linalg.lstsq(x * root[:, None], y * root, rcond=None)[0]
    return x @ beta


def test_huber_per_key_against_numpy(spark):
    both = line_series(spark, 1e5, outliers=10).withColumn("k", F.lit("a")).unionByName(
        line_series(spark, 2e5, seed=9).withColumn("k", F.lit(None).cast("string"))
    )
    rows = model.trend_huber(both, trained(both), CUT, ["k"]).orderBy("date").collect()
    for key in ("a", None):
        mine = [r for r in rows if r["k"] == key]
        train = [r for r in mine if r["date"] < dt.date(2001, 1, 1)]
        t = np.array([r["t"] for r in train])
        wanted = huber_by_hand(t, np.array([r["revenue"] for r in train]))
        assert np.allclose([r["revenue_trend"] for r in train], wanted, rtol=1e-9)
        assert len(mine) == 700


def test_huber_of_an_exact_line_and_of_nothing(spark):
    rows = [(dt.date(1999, 1, 1) + dt.timedelta(i), 100.0 + i, None) for i in range(50)]
    series = spark.createDataFrame(rows, "date date, revenue double, cogs double")
    got = model.trend_huber(series, trained(series), CUT).collect()
    assert all(r["revenue_trend"] == pytest.approx(r["revenue"]) and r["cogs_trend"] is None for r in got)


def test_a_kept_model_is_loaded_and_not_fitted(spark, small, monkeypatch):
    w = Warehouse(spark, small)
    fitted = sorted(map(tuple, queries._hybrid_forecast(w).collect()))
    root = publish_folder(spark, "kept")
    for layer in ("processed", "dim", "fact", "mart"):
        w.publish_layer(layer, LAYERS[layer], root)
    w.publish_model(root)

    def refuse(*_):
        raise AssertionError("fitted again")

    monkeypatch.setattr(model, "fit_residual", refuse)
    monkeypatch.setattr(model, "trend_params", refuse)
    opened = Warehouse.open(spark, small, root)
    assert sorted(map(tuple, queries._hybrid_forecast(opened).collect())) == fitted
    assert queries._residual_gbt(opened).count() == w.table("mart_sales_forecast_ready").count()
    other = Warehouse.open(spark, small, root, type(w.window)(train_end="2000-01-01"))
    with pytest.raises(ValueError, match="fitted under"):
        other.hybrid_model()


def test_folds_expand_and_never_look_ahead(spark, small):
    w = Warehouse(spark, small)
    days, years = w.table("sales"), w.window.fold_years
    assert years == (1998, 1999, 2000, 2001)
    folds = model.ts_cross_validation(days, years)
    spans = {
        (r["fold"], r["split"]): (r["lo"], r["hi"], r["n"])
        for r in folds.groupBy("fold", "split")
        .agg(F.min("date").alias("lo"), F.max("date").alias("hi"), F.count("*").alias("n"))
        .collect()
    }
    for number, year in enumerate(years, start=1):
        assert spans[number, "train"][1] < dt.date(year, 1, 1) <= spans[number, "test"][0]
        assert spans[number, "test"][1].year == year
        if number > 1:
            assert spans[number, "train"][2] == spans[number - 1, "train"][2] + spans[number - 1, "test"][2]


def test_metrics_agree_with_mllib(spark):
    rng = random.Random(3)
    rows = [("f", rng.gauss(5, 2), rng.gauss(9, 2), rng.gauss(5, 2), rng.gauss(9, 2)) for _ in range(50)]
    scored = spark.createDataFrame(
        rows, "fold string, revenue double, cogs double, revenue_pred double, cogs_pred double"
    )
    got = {r["target"]: r for r in model.forecast_metrics(scored, ["fold"]).collect()}
    for target in ("revenue", "cogs"):
        for metric in ("rmse", "mae", "r2"):
            evaluator = RegressionEvaluator(labelCol=target, predictionCol=f"{target}_pred", metricName=metric)
            assert got[target][metric] == pytest.approx(evaluator.evaluate(scored))
