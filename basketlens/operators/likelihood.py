"""Seasonal ARIMA (1,1,1)(1,1,0) by exact Gaussian likelihood, for many series at once.

The twice differenced series w is a stationary process (see ``forecast``) in state-space form: the state holds the
process and what is already known of its next m values, m being the season. The filter starts from the stationary
covariance of that state, so the first values count with the weight they have, and the levels before the first
difference are diffuse: the likelihood is that of w, exact at every length. Its Kalman recursion needs no matrix
product, since an observation settles the first element of the state and the rest moves up by one.

Coefficients lie inside the unit interval, which keeps the process stationary and invertible. A quasi-Newton search
(BFGS) moves all series of a batch together: the values for a gradient, or for several step lengths, are one stacked
filter run. One starts at zero, the other at the least-squares fit; the more likely end counts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from basketlens.operators.forecast import BOUND, fit_arima
from basketlens.operators.series import compact, cyclic
from basketlens.session import materialize, ship_package

STEPS = 80
CHUNK_BYTES = 64 << 20  # of state covariances in one filter run
EVERY = 1 << 30  # training values to keep


def differenced(values: np.ndarray, m: int) -> np.ndarray:
    """One step and one season; empty if there are too few values."""
    if len(values) < m + 2:
        return np.zeros(0)
    steps = np.diff(values)
    return steps[m:] - steps[:-m]


def stationary_covariance(ar: np.ndarray, theta: np.ndarray) -> np.ndarray:
    """Covariance of the state before the first value, for unit variance of the shocks: (n, r, r).

    The sum over all past shocks, doubled in length each round until nothing is added.
    """
    n, r = ar.shape
    move = np.zeros((n, r, r))
    move[:, :, 0] = ar
    move[:, np.arange(r - 1), np.arange(1, r)] = 1
    shock = np.zeros((n, r))
    shock[:, 0], shock[:, 1] = 1, theta
    total = shock[:, :, None] * shock[:, None, :]
    for _ in range(64):
        more = move @ total @ move.transpose(0, 2, 1)
        total = total + more
        if np.abs(more).max() <= 1e-15 * np.abs(total).max():
            break
        move = move @ move
    return total


def kalman(w: np.ndarray, length: np.ndarray, coef: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Log-likelihood with the variance at its best, that variance, and what the state predicts after the last value.

    ``w`` (n, t) holds each series from the left, ``length`` its values, ``coef`` (n, 3) phi, PHI and theta. Also
    returns the autoregressive coefficients (n, m + 1), which carry the state on.
    """
    n, r = len(w), m + 1
    phi, season, theta = coef.T
    ar = np.zeros((n, r))
    ar[:, 0] += phi
    ar[:, m - 1] += season
    ar[:, m] -= phi * season
    state, cover = np.zeros((n, r)), stationary_covariance(ar, theta)
    shock = np.zeros((n, r))
    shock[:, 0], shock[:, 1] = 1, theta
    noise = shock[:, :, None] * shock[:, None, :]
    square, logs, settled = np.zeros(n), np.zeros(n), False
    gain, spread = None, None
    for t in range(w.shape[1]):
        if not settled:
            spread = cover[:, 0, 0]
            gain = cover[:, :, 0] / spread[:, None]
            rest = cover - gain[:, :, None] * cover[:, None, :, 0]
            cover = noise.copy()
            cover[:, :-1, :-1] += rest[:, 1:, 1:]
            settled = bool((spread - 1 < 1e-14).all())
        here = t < length
        miss = w[:, t] - state[:, 0]
        square += np.where(here, miss * miss / spread, 0)
        logs += np.where(here, np.log(spread), 0)
        after = state + gain * miss[:, None]
        moved = ar * after[:, :1]
        moved[:, :-1] += after[:, 1:]
        state = np.where(here[:, None], moved, state)
    count = np.maximum(length, 1)
    variance = square / count
    with np.errstate(divide="ignore"):
        value = -0.5 * (count * (np.log(2 * np.pi * variance) + 1) + logs)
    return np.where(length > 0, value, np.nan), variance, state, ar


def ahead(state: np.ndarray, ar: np.ndarray, steps: int) -> np.ndarray:
    """Expected next values of w (n, steps)."""
    out = np.zeros((len(state), steps))
    for h in range(steps):
        out[:, h] = state[:, 0]
        moved = ar * state[:, :1]
        moved[:, :-1] += state[:, 1:]
        state = moved
    return out


def levels(values: np.ndarray, w: np.ndarray, m: int) -> np.ndarray:
    """The series carried on by differences ``w``."""
    y = list(values[-m - 1:])
    for x in w:
        y.append(x + y[-1] + y[-m] - y[-m - 1])
    return np.array(y[m + 1:])


def climb(w: np.ndarray, length: np.ndarray, start: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients of the likeliest fit reached from ``start``, and its log-likelihood."""
    n = len(w)
    count = np.maximum(length, 1)

    def cost(u: np.ndarray, of: np.ndarray) -> np.ndarray:
        """Of points (k, rows, 3), for the rows ``of``."""
        k, size = u.shape[:2]
        value = kalman(np.tile(w[of], (k, 1)), np.tile(length[of], k), BOUND * np.tanh(u).reshape(-1, 3), m)[0]
        return -value.reshape(k, size) / count[of]

    def with_slope(u: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        near = np.concatenate([np.zeros((1, 3)), 1e-5 * np.eye(3), -1e-5 * np.eye(3)])
        found = cost(u[None] + near[:, None, :], of)
        return found[0], ((found[1:4] - found[4:]) / 2e-5).T

    u = np.arctanh(np.clip(start / BOUND, -0.97, 0.97))
    lengths = np.array([1, 0.5, 0.2, 0.05, 0.005])
    best, slope = with_slope(u, np.arange(n))
    inverse = np.tile(np.eye(3), (n, 1, 1))
    active = np.flatnonzero(np.isfinite(best))
    for _ in range(STEPS):
        active = active[np.abs(slope[active]).max(axis=1) > 1e-7]
        if not len(active):
            break
        way = -np.einsum("nij,nj->ni", inverse[active], slope[active])
        uphill = (way * slope[active]).sum(axis=1) >= 0
        inverse[active[uphill]] = np.eye(3)
        way[uphill] = -slope[active[uphill]]
        way /= np.maximum(1, np.abs(way).max(axis=1, keepdims=True))
        tried = u[active][None] + lengths[:, None, None] * way[None]
        found = cost(tried, active)
        enough = found <= best[active] + 1e-4 * lengths[:, None] * (way * slope[active]).sum(axis=1)
        pick = np.where(enough.any(axis=0), enough.argmax(axis=0), -1)
        moved = pick >= 0
        here = active[moved]
        if not len(here):
            break
        step = tried[pick[moved], np.flatnonzero(moved)] - u[here]
        before, was = slope[here].copy(), best[here].copy()
        u[here] += step
        best[here], slope[here] = with_slope(u[here], here)
        turn = slope[here] - before
        curve = (step * turn).sum(axis=1)
        good = curve > 1e-14
        s, y, rho, h = step[good], turn[good], 1 / curve[good], inverse[here[good]]
        left = np.eye(3) - rho[:, None, None] * s[:, :, None] * y[:, None, :]
        inverse[here[good]] = left @ h @ left.transpose(0, 2, 1) + rho[:, None, None] * s[:, :, None] * s[:, None, :]
        active = here[was - best[here] > 1e-14 * np.maximum(1, np.abs(was))]
    return BOUND * np.tanh(u), -best * count


def fit_batch(values: Sequence[np.ndarray], starts: Sequence[np.ndarray | None], m: int, steps: int) -> list[dict | None]:
    """Per series the fit and its forecast; None where there is no difference to fit.

    Series whose differences are all zero have nothing to estimate: coefficients 0, no likelihood.
    """
    out: list[dict | None] = [None] * len(values)
    w = [differenced(v, m) for v in values]
    order = [i for i in np.argsort([len(x) for x in w], kind="stable") if len(w[i])]
    size = max(1, CHUNK_BYTES // (7 * 8 * (m + 1) ** 2))
    for begin in range(0, len(order), size):
        some = order[begin:begin + size]
        length = np.array([len(w[i]) for i in some])
        padded = np.stack([np.pad(w[i], (0, length.max() - len(w[i]))) for i in some])
        scale = np.sqrt((padded ** 2).sum(axis=1) / length)
        padded = padded / np.where(scale > 0, scale, 1)[:, None]
        least = np.stack([np.zeros(3) if starts[i] is None else np.asarray(starts[i], float) for i in some])
        least_value = kalman(padded, length, least, m)[0]
        fits = [climb(padded, length, start, m) for start in (least, np.zeros_like(least))]
        better = fits[1][1] > fits[0][1]
        coef = np.where((scale > 0)[:, None], np.where(better[:, None], fits[1][0], fits[0][0]), 0)
        value, variance, state, ar = kalman(padded, length, coef, m)
        next_w = ahead(state, ar, steps) * scale[:, None]
        shift = length * np.log(np.where(scale > 0, scale, 1))
        for k, i in enumerate(some):
            known = scale[k] > 0
            out[i] = {"coef": coef[k].tolist(), "rows": int(length[k]), "variance": float(variance[k] * scale[k] ** 2),
                      "loglik": float(value[k] - shift[k]) if known else None,
                      "least_squares_loglik": float(least_value[k] - shift[k]) if known and starts[i] is not None else None,
                      "ahead": levels(np.asarray(values[i], float), next_w[k], m).tolist()}
    return out


FIT = ("series_id string, coef array<double>, rows bigint, variance double, loglik double, least_squares_loglik double, "
       "ahead array<double>")


def _fits(m: int, steps: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in FIT.split(", ")]
        for batch in batches:
            values = [np.asarray(v, float) for v in batch["recent"]]
            found = fit_batch(values, list(batch["start"]), m, steps)
            yield pd.DataFrame([(name, *(fit and fit[c] for c in names[1:])) if fit else (name, *[None] * 6)
                                for name, fit in zip(batch["series_id"], found)], columns=names)
    return run


def fit_likelihood(series: DataFrame, seasonal_period: int, test_size: int, partitions: int | None = None) -> DataFrame:
    """Per series: ``coef`` (phi, PHI, theta), ``rows`` (differences), ``variance`` of the shocks, ``loglik``, the
    likelihood of the least-squares coefficients, and ``ahead``, the forecasts of the holdout.

    All but the id are NULL for a training part without a single difference. A series is fitted within one task;
    ``partitions`` (by default the session's number for shuffles) spreads the series, since the work is not in the bytes.
    """
    spark = series.sparkSession
    ship_package(spark)
    least = fit_arima(series, seasonal_period, test_size).select("series_id", F.col("coef").alias("start"))
    frame = compact(series, test_size, EVERY).select("series_id", "recent").join(least, "series_id", "left")
    spread = frame.repartition(partitions or int(spark.conf.get("spark.sql.shuffle.partitions")), "series_id")
    return spread.mapInPandas(_fits(seasonal_period, test_size), FIT)


def likelihood_forecast(series: DataFrame, seasonal_period: int, test_size: int, partitions: int | None = None) -> DataFrame:
    """``series_id, period, step, actual, forecast, naive`` of every holdout, the forecast by exact likelihood."""
    model = materialize(fit_likelihood(series, seasonal_period, test_size, partitions), "likelihood-fits")
    frame = compact(series, test_size, seasonal_period).join(model.select("series_id", "ahead"), "series_id", "left")
    rows = frame.select("series_id", "ahead", "recent", F.inline("holdout"))
    return rows.select("series_id", "period", "step", "actual", F.get("ahead", F.col("step") - 1).alias("forecast"),
                       cyclic("recent", seasonal_period, F.col("step")).alias("naive"))


def _at(coef: Sequence[float], m: int, steps: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for name, values in zip(batch["series_id"], batch["recent"]):
                w = differenced(values := np.asarray(values, float), m)
                if not len(w):
                    out.append((name, 0, None, None, None))
                    continue
                value, variance, state, ar = kalman(w[None], np.array([len(w)]), np.array([coef], float), m)
                next_w = ahead(state, ar, steps)[0]
                out.append((name, len(w), value[0] if variance[0] > 0 else None, variance[0], levels(values, next_w, m).tolist()))
            yield pd.DataFrame(out, columns=["series_id", "rows", "loglik", "variance", "ahead"])
    return run


def likelihood_at(series: DataFrame, seasonal_period: int, test_size: int, coef: Sequence[float]) -> DataFrame:
    """Exact log-likelihood of every training part at given phi, PHI and theta, each below 1 in size, the best variance of
    the shocks, and the forecasts ``ahead``."""
    if not all(abs(c) < 1 for c in coef):
        raise ValueError("coefficients have to lie between -1 and 1")
    ship_package(series.sparkSession)
    frame = compact(series, test_size, EVERY).select("series_id", "recent")
    return frame.mapInPandas(_at(list(coef), seasonal_period, test_size),
                             "series_id string, rows bigint, loglik double, variance double, ahead array<double>")
