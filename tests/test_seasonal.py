"""Seasonal baseline on hand-made series against plain Python."""

import datetime as dt
import math
import random
from collections import defaultdict

import pytest

from shelfcast.operators import seasonal
from shelfcast.operators.seasonal import ForecastWindow
from shelfcast.plans.queries import run
from shelfcast.plans.warehouse import Warehouse
from shelfcast.session import durable

WINDOW = ForecastWindow("2004-01-01", 2000, 2003, 2003, (2002, 2003))


def day(text):
    return dt.date.fromisoformat(text)


def series_frame(spark, rows):
    return spark.createDataFrame(rows, "date date, revenue double, cogs double")


def random_series(seed, years=range(2000, 2005)):
    rng = random.Random(seed)
    rows = []
    for year in years:
        first = dt.date(year, 1, 1)
        for offset in range(366 if year % 4 == 0 else 365):
            if rng.random() < 0.7:
                rows.append((first + dt.timedelta(offset), rng.uniform(10, 100) * (year - 1990), rng.uniform(5, 50)))
    return rows


def expected_forecast(rows, column, first_year, last_year, base_year, cut):
    """Direct restatement of the method for one target."""
    train = [(d, values[column]) for d, *values in rows if d < cut]
    totals, by_year = defaultdict(float), defaultdict(list)
    for d, value in train:
        totals[d.year] += value
        by_year[d.year].append(value)
    years = sorted(y for y in totals if first_year <= y <= last_year)
    steps = [totals[b] / totals[a] for a, b in zip(years, years[1:])]
    growth = math.prod(steps) ** (1 / len(steps))
    profile = defaultdict(list)
    for d, value in train:
        profile[d.month, d.day].append(value / (sum(by_year[d.year]) / len(by_year[d.year])))
    result = {}
    for d, *_ in rows:
        if d >= cut:
            known = profile.get((d.month, d.day))
            factor = sum(known) / len(known) if known else 1.0
            result[d] = totals[base_year] / 365 * growth ** (d.year - base_year) * factor
    return result


@pytest.mark.parametrize("seed", [1, 2])
def test_forecast_matches_direct_calculation(spark, seed):
    rows = random_series(seed)
    series = series_frame(spark, rows)
    sold = series.where(~WINDOW.is_train())
    got = seasonal.seasonal_forecast(series, WINDOW, horizon=sold).collect()
    for column, name in enumerate(seasonal.TARGETS):
        wanted = expected_forecast(rows, column, 2000, 2003, 2003, day("2004-01-01"))
        assert {r["date"] for r in got} == set(wanted)
        for r in got:
            assert r[f"{name}_pred"] == pytest.approx(wanted[r["date"]], abs=0.0051)


def test_horizon_is_the_calendar(spark):
    series = series_frame(spark, [r for r in random_series(3) if r[0] < day("2004-01-01")])
    rows = seasonal.seasonal_forecast(series, WINDOW).orderBy("date").collect()
    assert len(rows) == WINDOW.horizon_days == 548
    assert (rows[0]["date"], rows[-1]["date"]) == (day("2004-01-01"), day("2005-07-01"))
    assert all(r["revenue_pred"] is not None for r in rows)


def test_null_key_forecasts_like_any_other(spark):
    rows = [(k, *r) for r in random_series(4) for k in ("k", None)]
    keyed = spark.createDataFrame(rows, "k string, date date, revenue double, cogs double")
    got = seasonal.seasonal_forecast(keyed, WINDOW, ["k"]).collect()
    by = {(r["k"], r["date"]): r["revenue_pred"] for r in got}
    assert len(by) == 2 * WINDOW.horizon_days
    assert all(by[None, d] == by["k", d] is not None for k, d in by)


def test_growth_uses_adjacent_present_years(spark):
    rows = [(day("2000-05-01"), 100.0, 10.0), (day("2002-05-01"), 300.0, 20.0), (day("2003-05-01"), 150.0, 40.0)]
    changes = seasonal.yoy_change(seasonal.annual_totals(series_frame(spark, rows)))
    assert {r["year"]: r["revenue_change"] for r in changes.collect()} == {2002: 2.0, 2003: -0.5}
    growth = seasonal.geo_mean_growth(changes).first()
    assert growth["revenue_growth"] == pytest.approx((150 / 100) ** 0.5)
    assert growth["cogs_growth"] == pytest.approx((40 / 10) ** 0.5)


def test_missing_and_zero_values(spark):
    rows = [
        (day("2000-03-01"), None, 4.0), (day("2000-03-02"), 10.0, 6.0), (day("2001-03-01"), 0.0, 0.0),
        (day("2002-03-01"), 20.0, None),
    ]
    totals = {r["year"]: (r["revenue"], r["cogs"]) for r in seasonal.annual_totals(series_frame(spark, rows)).collect()}
    assert totals == {2000: (10.0, 10.0), 2001: (0.0, 0.0), 2002: (20.0, 0.0)}
    changes = seasonal.yoy_change(seasonal.annual_totals(series_frame(spark, rows)))
    assert [r["revenue_change"] for r in changes.orderBy("year").collect()] == [-1.0, None]
    normalised = seasonal.year_mean_normalise(series_frame(spark, rows))
    by_day = {r["date"]: (r["revenue_norm"], r["cogs_norm"]) for r in normalised.collect()}
    assert by_day[day("2000-03-01")] == (None, 0.8)
    assert by_day[day("2000-03-02")] == (1.0, 1.2)
    assert by_day[day("2001-03-01")] == (None, None)


def test_leap_day_and_unknown_day(spark):
    rows = [(day("2000-02-28"), 2.0, 1.0), (day("2000-02-29"), 4.0, 1.0), (day("2001-02-28"), 3.0, 1.0)]
    profile = seasonal.seasonal_profile(seasonal.year_mean_normalise(series_frame(spark, rows)))
    horizon = spark.createDataFrame([(day("2004-02-28"),), (day("2004-02-29"),), (day("2004-03-01"),)], "date date")
    season = {r["date"]: r["revenue_season"] for r in seasonal.seasonal_join(horizon, profile).collect()}
    assert season[day("2004-02-28")] == pytest.approx((2 / 3 + 1) / 2)
    assert season[day("2004-02-29")] == pytest.approx(4 / 3)
    assert season[day("2004-03-01")] == 1.0


def test_base_is_over_365_in_a_leap_year(spark):
    annual = seasonal.annual_totals(series_frame(spark, [(day("2000-01-01"), 730.0, 365.0)]))
    assert tuple(seasonal.base_level(annual, 2000).first()) == (2.0, 1.0)


def test_mape_skips_zero_actuals(spark):
    rows = [(100.0, 10.0, 110.0, 5.0), (0.0, 20.0, 5.0, 25.0), (None, 0.0, 5.0, 1.0)]
    scored = spark.createDataFrame(rows, "revenue double, cogs double, revenue_pred double, cogs_pred double")
    result = seasonal.forecast_mape(scored).first()
    assert result["revenue_mape"] == pytest.approx(10.0)
    assert result["cogs_mape"] == pytest.approx((50 + 25) / 2)


def test_keys_are_independent_series(spark):
    rows = {k: random_series(k) for k in (3, 4)}
    flat = [(str(k), *row) for k, series in rows.items() for row in series]
    flat.append(("no base year", day("2000-06-01"), 5.0, 5.0))
    flat.append(("no base year", day("2004-06-01"), 5.0, 5.0))
    frame = spark.createDataFrame(flat, "shop string, date date, revenue double, cogs double")
    got = {(r["shop"], r["date"]): r["revenue_pred"] for r in
           seasonal.seasonal_forecast(frame, WINDOW, ["shop"]).collect()}
    for k, series in rows.items():
        for r in seasonal.seasonal_forecast(series_frame(spark, series), WINDOW).collect():
            assert got[str(k), r["date"]] == pytest.approx(r["revenue_pred"], abs=0.011)
    assert got["no base year", day("2004-06-01")] is None


def test_year_means_are_one_and_growth_telescopes(spark, small):
    w = Warehouse(spark, small)
    series = durable(w.table("sales"), "sales")
    normalised = seasonal.year_mean_normalise(series)
    for r in normalised.groupBy("year").avg("revenue_norm").collect():
        assert r[1] == pytest.approx(1.0)
    annual = seasonal.full_year_slice(seasonal.annual_totals(series), 1996, 2000)
    totals = {r["year"]: r["revenue"] for r in annual.collect()}
    growth = seasonal.geo_mean_growth(seasonal.yoy_change(annual)).first()["revenue_growth"]
    assert growth == pytest.approx((totals[2000] / totals[1996]) ** 0.25)
    assert growth == pytest.approx(0.992763, abs=1e-6)


def test_hold_out_error_on_test_tables(spark, small):
    hold_out = {r["sample"]: r["revenue_mape"] for r in run("forecast_mape", spark, small).collect()}
    assert hold_out["hold_out"] == pytest.approx(129.895, abs=1e-3)


def test_keyed_series_adds_up_to_the_lines(spark, small):
    w = Warehouse(spark, small)
    keyed = w.table("keyed_series").groupBy().sum("revenue").first()[0]
    assert keyed == w.table("fact_sales_item").groupBy().sum("net").first()[0]


def test_preview_is_ordered_by_date(spark):
    rows = [(day("2000-01-01") + dt.timedelta(i), float(i), 0.0) for i in (5, 3, 9, 1, 7)]
    preview = seasonal.series_preview(series_frame(spark, rows), 2).collect()
    assert sorted((r["side"], r["revenue"]) for r in preview) == [
        ("head", 1.0), ("head", 3.0), ("tail", 7.0), ("tail", 9.0),
    ]
