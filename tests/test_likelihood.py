"""The exact likelihood against the dense Gaussian density of short series, and the fit against a search on a grid."""

import datetime
import itertools

import numpy as np
import pytest

from basketlens.operators import likelihood as lk
from basketlens.operators import series as ts

DAY = datetime.date(2020, 1, 1)


def covariance(phi, season, theta, m, n, past=20000):
    """Dense covariance of w over n values, from its weights on past shocks."""
    a = np.convolve([1, -phi], np.r_[1, np.zeros(m - 1), -season])
    psi = np.zeros(past)
    psi[0] = 1
    for k in range(1, past):
        psi[k] = (theta if k == 1 else 0) - sum(a[j] * psi[k - j] for j in (1, m, m + 1) if j <= k)
    gamma = np.array([psi[:past - k] @ psi[k:] for k in range(n)])
    return gamma[np.abs(np.subtract.outer(np.arange(n), np.arange(n)))]


def dense(w, coef, m):
    cover = covariance(*coef, m, len(w))
    square = w @ np.linalg.solve(cover, w) / len(w)
    return -0.5 * (len(w) * (np.log(2 * np.pi * square) + 1) + np.linalg.slogdet(cover)[1]), square


@pytest.mark.parametrize("m, coef", [(4, (0.5, -0.6, 0.3)), (4, (-0.7, 0.4, -0.9)), (12, (0.2, 0.5, 0.0)), (2, (0.6, 0.3, 0.5)), (3, (0, 0, 0))])
def test_likelihood_equals_the_dense_density(m, coef):
    draw = np.random.default_rng(m)
    for n in (1, 2, m, m + 1, 40):
        w = draw.normal(size=n) * 3
        value, variance, _, _ = lk.kalman(w[None], np.array([n]), np.array([coef]), m)
        assert np.allclose([value[0], variance[0]], dense(w, coef, m), rtol=1e-9)


def test_series_of_different_lengths_share_a_run():
    draw = np.random.default_rng(1)
    coef = np.array([(0.5, -0.6, 0.3), (0.1, 0.2, -0.3), (0.0, 0.9, 0.4)])
    w = [draw.normal(size=n) for n in (5, 30, 17)]
    padded = np.stack([np.pad(x, (0, 30 - len(x))) for x in w])
    together = lk.kalman(padded, np.array([5, 30, 17]), coef, 4)
    for i, x in enumerate(w):
        alone = lk.kalman(x[None], np.array([len(x)]), coef[i:i + 1], 4)
        assert all(np.allclose(a[i], b[0]) for a, b in zip(together, alone))


def test_forecast_is_the_conditional_mean():
    draw, coef, m = np.random.default_rng(2), (0.4, -0.5, 0.6), 4
    w = draw.normal(size=25)
    _, _, state, ar = lk.kalman(w[None], np.array([25]), np.array([coef]), m)
    cover = covariance(*coef, m, 31)
    want = cover[25:, :25] @ np.linalg.solve(cover[:25, :25], w)
    assert np.allclose(lk.ahead(state, ar, 6)[0], want, rtol=1e-8)


def simulated(draw, coef, m, n):
    phi, season, theta = coef
    e, w = draw.normal(size=n + 300), np.zeros(n + 300)
    for t in range(m + 1, n + 300):
        w[t] = phi * w[t - 1] + season * w[t - m] - phi * season * w[t - m - 1] + e[t] + theta * e[t - 1]
    y = list(draw.normal(size=m + 1) * 10 + 100)
    for x in w[300:]:
        y.append(x + y[-1] + y[-m] - y[-m - 1])
    return np.array(y)


def test_fit_is_as_likely_as_any_point_of_a_grid():
    draw, m = np.random.default_rng(3), 4
    values = [simulated(draw, c, m, n) for c in ((0.6, -0.5, 0.2), (-0.3, 0.7, -0.6)) for n in (12, 30, 120)]
    grid = list(itertools.product((-0.9, -0.6, -0.3, 0, 0.3, 0.6, 0.9), repeat=3))
    for v, fit in zip(values, lk.fit_batch(values, [np.zeros(3)] * len(values), m, 3)):
        w = lk.differenced(v, m)
        most = max(lk.kalman(w[None], np.array([len(w)]), np.array([c]), m)[0][0] for c in grid)
        assert fit["loglik"] >= most - 1e-6 and fit["loglik"] >= fit["least_squares_loglik"] - 1e-9
        assert np.isclose(fit["loglik"], dense(w, fit["coef"], m)[0], rtol=1e-7)


def test_long_series_give_their_coefficients_back():
    coef = (0.5, -0.4, 0.3)
    fit = lk.fit_batch([simulated(np.random.default_rng(4), coef, 12, 3000)], [None], 12, 1)[0]
    assert np.abs(np.array(fit["coef"]) - coef).max() < 0.08 and abs(fit["variance"] - 1) < 0.1


def test_frames_equal_the_numbers_of_each_series(spark):
    draw, m, test = np.random.default_rng(5), 4, 3
    values = {f"s{i}": simulated(draw, (0.3, -0.2, 0.4), m, 20 + 5 * i) for i in range(6)}
    values |= {"short": np.arange(8.0), "flat": np.full(30, 5.0), "two": np.array([1.0, 2.0])}
    rows = [(k, DAY + datetime.timedelta(days=i), float(x)) for k, v in values.items() for i, x in enumerate(v)]
    series = spark.createDataFrame(rows, "series_id string, period date, net_sales double").repartition(3)
    fits = {r.series_id: r for r in lk.fit_likelihood(series, m, test, partitions=3).collect()}
    assert set(fits) == set(values) and fits["short"].coef is None and fits["two"].ahead is None
    assert fits["flat"].coef == [0, 0, 0] and fits["flat"].loglik is None and fits["flat"].ahead == [5.0] * 3
    table = lk.likelihood_forecast(series, m, test, partitions=2)
    assert table.columns == ["series_id", "period", "step", "actual", "forecast", "naive"]
    got = {(r.series_id, r.step): r for r in table.collect()}
    for i in range(6):
        fit, w = fits[f"s{i}"], lk.differenced(values[f"s{i}"][:-test], m)
        assert fit.rows == len(w) and fit.loglik >= fit.least_squares_loglik - 1e-9
        assert np.isclose(fit.loglik, dense(w, fit.coef, m)[0], rtol=1e-6)
        assert [got[f"s{i}", h].forecast for h in (1, 2, 3)] == pytest.approx(fit.ahead)
        assert got[f"s{i}", 2].actual == values[f"s{i}"][-2]
    assert got["short", 1].forecast is None
    given = {r.series_id: r for r in lk.likelihood_at(series, m, test, (0.3, -0.2, 0.4)).collect()}
    assert np.isclose(given["s4"].loglik, dense(lk.differenced(values["s4"][:-test], m), (0.3, -0.2, 0.4), m)[0])
    assert given["s4"].loglik <= fits["s4"].loglik + 1e-9 and given["two"].loglik is None
    with pytest.raises(ValueError):
        lk.likelihood_at(series, m, test, (1.0, 0, 0))


def test_no_series(spark):
    empty = spark.createDataFrame([], "series_id string, period date, net_sales double")
    assert lk.likelihood_forecast(empty, 4, 3).count() == 0
    assert ts.model_errors(lk.likelihood_forecast(empty, 4, 3)).count() == 0
