import datetime
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlens.operators import forecast as fc, series as ts


def month(i):
    return datetime.date(2000 + i // 12, i % 12 + 1, 1)


def monthly(spark, values, series_id="s"):
    return spark.createDataFrame([(series_id, month(i), float(v)) for i, v in enumerate(values)],
                                 "series_id string, period date, net_sales double")


def daily(spark, start, values):
    rows = [(start + datetime.timedelta(days=i), float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "day date, net_sales double")


def test_gaps_are_zero(spark):
    df = spark.createDataFrame([(datetime.date(2020, 1, 1), 5.0), (datetime.date(2020, 1, 4), 7.0)],
                               "day date, net_sales double")
    rows = ts.daily_sales_dense(df).orderBy("period").collect()
    assert [(r.period.day, r.net_sales) for r in rows] == [(1, 5.0), (2, 0.0), (3, 0.0), (4, 7.0)]


@pytest.mark.parametrize("last, cutoff", [
    ("2011-12-09", "2011-11-30"),   # the month end is the earlier one
    ("2001-08-01", "2001-07-30"),   # the Monday is the earlier one
    ("2022-01-31", "2022-01-31"),   # a month end that is a Monday
    ("2022-05-31", "2022-05-30"),
])
def test_trim_cutoff(spark, last, cutoff):
    row = spark.range(1).select(ts.trim_cutoff(F.lit(last).cast("date"))).first()
    assert str(row[0]) == cutoff


def test_weeks_end_on_monday_and_the_first_is_kept_partial(spark):
    df = ts.daily_sales_dense(daily(spark, datetime.date(2022, 1, 1), [1] * 11))  # a Saturday to a Tuesday
    rows = ts.weekly_sales(df).orderBy("period").collect()
    assert [(str(r.period), r.net_sales) for r in rows] == [("2022-01-03", 3.0), ("2022-01-10", 7.0), ("2022-01-17", 1.0)]


@pytest.mark.parametrize("n, p", [(36, 12), (41, 12), (21, 7)])
def test_decomposition_matches_a_convolution(spark, n, p):
    y = np.random.default_rng(n).normal(size=n) + np.arange(n)
    rows = ts.decompose(monthly(spark, y), p).orderBy("period").collect()
    weights = np.r_[0.5, np.ones(p - 1), 0.5] / p if p % 2 == 0 else np.ones(p) / p
    h = p // 2
    trend = np.full(n, np.nan)
    trend[h:n - h] = np.convolve(y, weights, "valid")
    slots = np.array([np.nanmean((y - trend)[i::p]) for i in range(p)])
    seasonal = np.resize(slots - slots.mean(), n)
    for r, t, s in zip(rows, trend, seasonal):
        assert r.seasonal == pytest.approx(s)
        if math.isnan(t):
            assert r.trend is None and r.resid is None
        else:
            assert r.trend == pytest.approx(t)
            assert r.net_sales == pytest.approx(r.trend + r.seasonal + r.resid)


def test_two_cycles_leave_no_residual_and_fewer_none_at_all(spark):
    y = np.random.default_rng(1).normal(size=24)
    row = ts.residual_noise_fraction(monthly(spark, y), 12).first()
    assert row.noise_fraction == pytest.approx(0, abs=1e-20) and row.cycles == 2
    assert ts.residual_noise_fraction(monthly(spark, y[:23]), 12).first().noise_fraction is None


def test_granularity_of_a_short_history_is_not_comparable(spark):
    y = np.random.default_rng(2).normal(size=731) + 10
    row = ts.choose_granularity(ts.daily_sales_dense(daily(spark, datetime.date(2009, 12, 1), y))).first()
    assert row.comparable is False and row.grain in ("weekly", "monthly")


def test_naive_repeats_the_cycle(spark):
    rows = ts.seasonal_naive(monthly(spark, [9, 9, 1, 2, 3, 0, 0, 0, 0, 0]), 3, 5).orderBy("period").collect()
    assert [r.forecast for r in rows] == [1, 2, 3, 1, 2]
    short = ts.seasonal_naive(monthly(spark, [4, 5, 0, 0, 0]), 12, 3).orderBy("period").collect()
    assert [r.forecast for r in short] == [4, 5, 4]
    history = ts.recent_history(monthly(spark, range(20)), 3).orderBy("period").collect()
    assert [r.net_sales for r in history] == list(range(8, 17))


def test_two_years_get_a_model_forecast(spark):
    rng = np.random.default_rng(3)
    every = None
    for name, n in {"five": 60, "two": 24, "short": 14, "flat": 30}.items():
        one = monthly(spark, 100 + rng.normal(size=n) * (name != "flat"), name)
        every = one if every is None else every.unionByName(one)
    rows = fc.seasonal_arima_forecast(every, 12, 3).collect()
    assert len(rows) == 12 and "tier" not in rows[0].asDict()
    assert all((r.forecast is None) == (r.series_id == "short") and r.naive is not None for r in rows)
    assert any(r.forecast != r.naive for r in rows if r.series_id == "two")
    assert all(r.forecast == pytest.approx(100) for r in rows if r.series_id == "flat")
    verdict = {r.series_id: r for r in ts.model_errors(fc.seasonal_arima_forecast(every, 12, 3)).collect()}
    assert verdict["short"].beats_naive is None
    assert verdict["two"].beats_naive == (verdict["two"].mae < verdict["two"].naive_mae)


def reference_forecast(y, m, h, steps=6):
    """The same fit written out with plain loops."""
    n = len(y)
    w = [None] * (m + 1) + [y[t] - y[t - 1] - y[t - m] + y[t - m - 1] for t in range(m + 1, n)]
    at = lambda a, t: 0.0 if t < 0 or a[t] is None else a[t]
    rows = range(m + 1, n)
    x = np.array([[at(w, t - k) for k in (1, 2, 3, m, m + 1)] for t in rows])
    target = np.array([w[t] for t in rows])
    e = [None] * (m + 1) + list(target - x @ np.linalg.lstsq(x, target, rcond=None)[0])
    terms = np.array([[at(w, t - 1), at(w, t - m), at(w, t - m - 1), at(e, t - 1)] for t in rows])
    a = np.zeros(3)
    for _ in range(steps):
        r = target - terms @ np.array([a[0], a[1], -a[0] * a[1], a[2]])
        j = -np.stack([terms[:, 0] - a[1] * terms[:, 2], terms[:, 1] - a[0] * terms[:, 2], terms[:, 3]], axis=1)
        a = np.clip(a - np.linalg.lstsq(j, r, rcond=None)[0], -0.99, 0.99)
    w, y, shock = list(w), list(y), e[-1]
    for _ in range(h):
        w.append(a[0] * at(w, len(w) - 1) + a[1] * at(w, len(w) - m) - a[0] * a[1] * at(w, len(w) - m - 1) + a[2] * shock)
        y.append(w[-1] + y[-1] + y[-m] - y[-m - 1])
        shock = 0.0
    return y[-h:]


@pytest.mark.parametrize("n", [24, 27, 33, 70])
def test_seasonal_forecast_matches_plain_loops(spark, n):
    rng = np.random.default_rng(4)
    y = 50 + 10 * np.sin(np.arange(n) * np.pi / 6) + rng.normal(size=n).cumsum()
    rows = fc.seasonal_arima_forecast(monthly(spark, y), 12, 3).orderBy("period").collect()
    assert [r.forecast for r in rows] == pytest.approx(reference_forecast(y[:n - 3], 12, 3), rel=1e-6)
    errors = ts.forecast_errors(fc.seasonal_arima_forecast(monthly(spark, y), 12, 3)).first()
    assert errors.mae == pytest.approx(np.mean([abs(r.actual - r.forecast) for r in rows]))
