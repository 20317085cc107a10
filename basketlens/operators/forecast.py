"""Seasonal ARIMA (1,1,1)(1,1,0) forecasts for many series at once, by one method at every length.

With w the series differenced once by a step and once by a season of m, the model is

    w_t = phi w_{t-1} + PHI w_{t-m} - phi PHI w_{t-m-1} + e_t + theta e_{t-1}

It is fitted by conditional least squares: values before the first difference count as zero, and so does a term
that a short history never sees. A long autoregression supplies residuals that stand in for e (Hannan and Rissanen,
1982); then a fixed number of Gauss-Newton steps fits the three coefficients, the one of w_{t-m-1} tied to their
product. Both work on sums of products, one grouped aggregate each over all series; numpy solves the few numbers of
all series of a batch at once, with the solution of least norm where the sums leave a choice. It is not an
exact-likelihood fit, so figures differ from one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from basketlens.operators.series import compact, cyclic, in_order, train_test_split
from basketlens.session import materialize, ship_package

STEPS = 6
BOUND = 0.99  # of each coefficient: beyond it forecasts would grow without end
LONG = ["w_1", "w_2", "w_3", "w_m", "w_m1"]
TERMS = ["w", "w_1", "w_m", "w_m1", "e_1"]


def arima_differences(series: DataFrame, seasonal_period: int) -> DataFrame:
    """The series differenced once by one step and once by the season, with the lags a fit uses."""
    m = seasonal_period
    y = F.col("net_sales")
    lag = lambda c, k: F.lag(c, k).over(in_order())
    differenced = series.withColumn("w", y - lag(y, 1) - lag(y, m) + lag(y, m + 1))
    lags = {"w_1": 1, "w_2": 2, "w_3": 3, "w_m": m, "w_m1": m + 1}
    return differenced.withColumns({name: lag("w", k) for name, k in lags.items()})


def normal_equations(regressors: list[str], name: str, target: str = "w") -> list[Column]:
    """Aggregates of a regression over the rows that have a target; a missing regressor counts as zero."""
    of = lambda c: f"coalesce({c}, 0D)"
    total = lambda a, b: f"sum(case when {target} is not null then {of(a)} * {of(b)} end)"
    return [
        F.expr(f"count({target})").alias(f"{name}_rows"),
        F.expr(f"array({', '.join(total(a, b) for a in regressors for b in regressors)})").alias(f"{name}_gram"),
        F.expr(f"array({', '.join(total(a, target) for a in regressors)})").alias(f"{name}_moment"),
    ]


def solve_all(gram: np.ndarray, moment: np.ndarray) -> np.ndarray:
    """Least-norm solutions of many systems (n, p, p) x (n, p), each scaled to a unit diagonal first."""
    scale = np.sqrt(np.einsum("npp->np", gram))
    scale = np.where(scale > 0, scale, 1.0)
    inverse = np.linalg.pinv(gram / scale[:, :, None] / scale[:, None, :], rcond=1e-12, hermitian=True)
    return np.einsum("npq,nq->np", inverse, moment / scale) / scale


def gauss_newton(products: np.ndarray) -> np.ndarray:
    """phi, PHI and theta of many series from the sums of products (n, 5, 5) of TERMS."""
    n = len(products)
    phi, season, theta = np.zeros((3, n))
    one, zero = np.ones(n), np.zeros(n)
    for _ in range(STEPS):
        residual = np.stack([one, -phi, -season, phi * season, -theta], axis=1)
        slopes = np.stack([np.stack(row, axis=1) for row in (
            [zero, -one, zero, season, zero], [zero, zero, -one, phi, zero], [zero, zero, zero, zero, -one])], axis=1)
        gram = slopes @ products @ slopes.transpose(0, 2, 1)
        move = solve_all(gram, np.einsum("npt,ntu,nu->np", slopes, products, residual))
        phi, season, theta = np.clip(np.stack([phi, season, theta]) - move.T, -BOUND, BOUND)
    return np.stack([phi, season, theta], axis=1)


def _known(*columns: pd.Series) -> np.ndarray:
    return np.array([all(v is not None and not pd.isna(np.asarray(v, float)).any() for v in row) for row in zip(*columns)], bool)


def _listed(known: np.ndarray, rows: np.ndarray) -> pd.Series:
    found = iter(rows)
    return pd.Series([next(found) if k else None for k in known], dtype=object)


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def solve(gram: pd.Series, moment: pd.Series) -> pd.Series:
    """Coefficients of one regression per row; NULL for a series without differences."""
    known = _known(gram, moment)
    if not known.any():
        return _listed(known, [])
    b = np.stack([np.asarray(v, float) for v in moment[known]])
    return _listed(known, solve_all(np.stack([np.asarray(v, float) for v in gram[known]]).reshape(len(b), b.shape[1], -1), b))


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def coefficients(products: pd.Series) -> pd.Series:
    known = _known(products)
    if not known.any():
        return _listed(known, [])
    return _listed(known, gauss_newton(np.stack([np.asarray(v, float) for v in products[known]]).reshape(-1, 5, 5)))


def fit_arima(series: DataFrame, seasonal_period: int, test_size: int) -> DataFrame:
    """Per series: ``coef`` (phi, PHI, theta) and the last residual, NULL without a single difference.

    The lagged rows are stored, as both aggregates read them.
    """
    ship_package(series.sparkSession)
    train = train_test_split(series, test_size).filter(~F.col("is_test")).select("series_id", "period", "net_sales")
    lagged = materialize(arima_differences(train, seasonal_period).drop("net_sales"), "lagged")
    long = lagged.groupBy("series_id").agg(*normal_equations(LONG, "long"))
    long = long.select("series_id", solve("long_gram", "long_moment").alias("long"))
    fitted = sum((F.get("long", i) * F.coalesce(F.col(c), F.lit(0.0)) for i, c in enumerate(LONG)), F.lit(0.0))
    residuals = lagged.join(long, "series_id").withColumn("e", F.col("w") - fitted).withColumn(
        "e_1", F.lag("e").over(in_order()))
    sums = residuals.groupBy("series_id").agg(*normal_equations(TERMS, "terms"), F.max_by("e", "period").alias("last_residual"))
    return sums.select("series_id", coefficients("terms_gram").alias("coef"), "last_residual")


def seasonal_arima_forecast(series: DataFrame, seasonal_period: int, test_size: int) -> DataFrame:
    """Forecast the holdout of every series from its training part.

    Columns: ``series_id, period, step, actual, forecast, naive``. ``forecast`` is the model's, NULL where the
    training part is too short for a single difference (a season and two values); ``naive`` repeats the last season.
    """
    m = seasonal_period
    model = fit_arima(series, m, test_size)
    # 2m + 2 values give the m + 1 latest differences that the first step looks back on.
    frame = compact(series, test_size, 2 * m + 2).join(model, "series_id", "left")
    y = lambda values, back: F.coalesce(F.try_element_at(values, F.lit(-back)), F.lit(0.0))
    at = lambda i: F.get("recent", i)
    differences = F.when(F.size("recent") > m + 1, F.transform(
        F.sequence(F.lit(m + 1), F.size("recent") - 1),
        lambda i: at(i) - at(i - 1) - at(i - m) + at(i - m - 1)))
    frame = frame.withColumn("w", differences)
    phi, season, theta = (F.get("coef", i) for i in range(3))

    def step(state: Column, h: Column) -> Column:
        shock = F.when(h == 1, F.coalesce(F.col("last_residual"), F.lit(0.0))).otherwise(0.0)
        w = phi * y(state.w, 1) + season * y(state.w, m) - phi * season * y(state.w, m + 1) + theta * shock
        level = y(state.y, 1) + y(state.y, m) - y(state.y, m + 1)
        return F.struct(F.concat(state.y, F.array(level + w)).alias("y"), F.concat(state.w, F.array(w)).alias("w"))

    start = F.struct(F.col("recent").alias("y"), F.col("w").alias("w"))
    path = F.aggregate(F.sequence(F.lit(1), F.lit(test_size)), start, step, lambda state: state.y)
    ahead = frame.withColumn("ahead", F.when(F.col("coef").isNotNull(), F.slice(path, -test_size, test_size)))
    rows = ahead.select("series_id", "ahead", "recent", F.inline("holdout"))
    return rows.select("series_id", "period", "step", "actual", F.get("ahead", F.col("step") - 1).alias("forecast"),
                       cyclic("recent", m, F.col("step")).alias("naive"))
