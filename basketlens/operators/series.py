"""Gap-free sales series, one or many at once.

A series frame has ``series_id, period, net_sales``; the single total series carries a constant id.
Every window is partitioned by ``series_id`` and holds one row per period, so its size is bounded by
the length of the history whatever the number of sales lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

# Seasonal period and holdout length of each grain.
SEASONAL_PERIOD = {"weekly": 52, "monthly": 12}
HOLDOUT = {"weekly": 12, "monthly": 3}
TOTAL = "total"


def whole():
    return W.partitionBy("series_id")


def in_order():
    return whole().orderBy("period")


def daily_sales_dense(daily: DataFrame) -> DataFrame:
    """Fill the days between the first and the last sale with zero.

    Each day is stretched up to the day before the next one: no calendar to build, no join.
    """
    if "series_id" not in daily.columns:
        daily = daily.withColumn("series_id", F.lit(TOTAL))
    following = F.lead("day").over(whole().orderBy("day"))
    until = F.coalesce(F.date_sub(following, 1), F.col("day"))
    return (
        daily.withColumn("_days", F.sequence("day", until))
        .select("series_id", "day", "net_sales", F.explode("_days").alias("period"))
        .select(
            "series_id", "period",
            F.when(F.col("period") == F.col("day"), F.col("net_sales").cast("double")).otherwise(0.0)
            .alias("net_sales"),
        )
    )


def trim_cutoff(last: Column) -> Column:
    """The earlier of the last complete month's end and the last Monday on or before ``last``."""
    month_end = F.when(F.last_day(last) == last, last).otherwise(F.date_sub(F.trunc(last, "month"), 1))
    week_end = F.date_sub(last, F.weekday(last))
    return F.least(month_end, week_end)


def trim_partial_periods(dense: DataFrame) -> DataFrame:
    """Drop the days after the cutoff of the series. The first period is kept even if partial."""
    last = F.max("period").over(whole())
    return dense.withColumn("_cutoff", trim_cutoff(last)).filter("period <= _cutoff").drop("_cutoff")


def weekly_sales(dense: DataFrame) -> DataFrame:
    """Weeks from Tuesday to the Monday that names them."""
    return _resample(dense, F.next_day(F.date_sub("period", 1), "MO"))


def monthly_resample(dense: DataFrame) -> DataFrame:
    """Calendar months named by their first day."""
    return _resample(dense, F.trunc("period", "month"))


def _resample(dense: DataFrame, period: Column) -> DataFrame:
    return dense.groupBy("series_id", period.alias("period")).agg(F.sum("net_sales").alias("net_sales"))


RESAMPLE = {"weekly": weekly_sales, "monthly": monthly_resample}


def numbered(series: DataFrame) -> DataFrame:
    """Add the 0-based position ``pos`` and the length ``points`` of the series."""
    return series.withColumn("pos", F.row_number().over(in_order()) - 1).withColumn(
        "points", F.count("*").over(whole()))


def decompose(series: DataFrame, seasonal_period: int) -> DataFrame:
    """Classical additive decomposition: ``trend``, ``seasonal`` and ``resid`` columns.

    The trend is the centred moving average (half weights at both ends for an even period) and is
    NULL for half a period at each end. A seasonal value is the mean detrended value of its position
    in the cycle, centred over the cycle. With fewer than two cycles all three are NULL.
    """
    p, half = seasonal_period, seasonal_period // 2
    mean_over = lambda start, end: F.avg("net_sales").over(in_order().rowsBetween(start, end))
    moving = (mean_over(-half, half - 1) + mean_over(1 - half, half)) / 2 if p % 2 == 0 else mean_over(-half, half)
    inside = (F.col("pos") >= half) & (F.col("pos") < F.col("points") - half) & (F.col("points") >= 2 * p)
    slot = W.partitionBy("series_id", "_slot")
    return (
        numbered(series)
        .withColumn("trend", F.when(inside, moving))
        .withColumn("_slot", F.col("pos") % p)
        .withColumn("_raw", F.avg(F.col("net_sales") - F.col("trend")).over(slot))
        .withColumn("seasonal", F.col("_raw") - F.avg(F.when(F.col("pos") < p, F.col("_raw"))).over(whole()))
        .withColumn("resid", F.col("net_sales") - F.col("trend") - F.col("seasonal"))
        .drop("_slot", "_raw")
    )


def residual_noise_fraction(series: DataFrame, seasonal_period: int) -> DataFrame:
    """Share of the series variance left in the residual, with the number of points and cycles."""
    spread = F.var_samp("net_sales")
    return decompose(series, seasonal_period).groupBy("series_id").agg(
        F.count("*").alias("points"),
        F.floor(F.count("*") / seasonal_period).cast("int").alias("cycles"),
        F.when(spread > 0, F.var_samp("resid") / F.nullif(spread, F.lit(0.0))).alias("noise_fraction"),
    )


def choose_granularity(dense: DataFrame) -> DataFrame:
    """Weekly if its residual share is strictly lower, else monthly; one row per series.

    With two cycles every seasonal slot has a single value, so the residual is flat for any data and
    its share says nothing: ``comparable`` is true only from three cycles on for both grains. A series
    of fewer than two cycles of either grain has no decomposition; that is an error which names it.
    """
    sides = {
        grain: residual_noise_fraction(RESAMPLE[grain](dense), SEASONAL_PERIOD[grain]).select(
            "series_id", *[F.col(c).alias(f"{grain}_{c}") for c in ("points", "cycles", "noise_fraction")])
        for grain in ("weekly", "monthly")
    }
    weekly = F.coalesce(F.col("weekly_noise_fraction") < F.col("monthly_noise_fraction"), F.lit(False))
    pick = lambda values: F.when(weekly, F.lit(values["weekly"])).otherwise(F.lit(values["monthly"]))
    both = sides["weekly"].join(sides["monthly"], "series_id")
    short = (F.col("weekly_cycles") < 2) | (F.col("monthly_cycles") < 2)
    name = F.concat(F.lit("no decomposition: fewer than two seasonal cycles in series "), F.col("series_id"))
    both = both.withColumn("weekly_cycles", F.when(short, F.raise_error(name).cast("int")).otherwise(F.col("weekly_cycles")))
    return both.select(
        "*",
        ((F.col("weekly_cycles") >= 3) & (F.col("monthly_cycles") >= 3)).alias("comparable"),
        F.when(weekly, "weekly").otherwise("monthly").alias("grain"),
        pick(SEASONAL_PERIOD).alias("seasonal_period"),
        pick(HOLDOUT).alias("test_size"),
    )


def train_test_split(series: DataFrame, test_size: int) -> DataFrame:
    """Mark the last ``test_size`` periods of each series: ``step`` is 1, 2, ... there, NULL in training."""
    frame = numbered(series).withColumn("_train", F.greatest(F.col("points") - test_size, F.lit(0)))
    return frame.withColumn("is_test", F.col("pos") >= F.col("_train")).withColumn(
        "step", F.when(F.col("is_test"), F.col("pos") - F.col("_train") + 1).cast("int")).drop("_train")


def recent_history(series: DataFrame, test_size: int, factor: int = 3) -> DataFrame:
    """The last ``factor * test_size`` training periods, as the backtest chart shows them."""
    train = train_test_split(series, test_size).filter(~F.col("is_test"))
    newest = F.row_number().over(whole().orderBy(F.col("period").desc()))
    return train.withColumn("_age", newest).filter(F.col("_age") <= factor * test_size).select(
        "series_id", "period", "net_sales")


def compact(series: DataFrame, test_size: int, tail: int) -> DataFrame:
    """One row per series: the last ``tail`` training values in order, and the held-out rows."""
    split = train_test_split(series, test_size)
    in_tail = ~F.col("is_test") & (F.col("pos") >= F.col("points") - test_size - tail)
    row = lambda when, *fields: F.sort_array(F.collect_list(F.when(when, F.struct(*fields))))
    return split.groupBy("series_id").agg(
        F.transform(row(in_tail, "pos", "net_sales"), lambda r: r.net_sales).alias("recent"),
        row(F.col("is_test"), "step", "period", F.col("net_sales").alias("actual")).alias("holdout"),
        F.count_if(~F.col("is_test")).alias("train_points"),
    )


def cyclic(recent: str, seasonal_period: int, step: Column) -> Column:
    """The last cycle of the array repeated: the value ``step`` periods after its end."""
    cycle = F.least(F.size(recent), F.lit(seasonal_period))
    slot = (step - 1) % F.nullif(cycle, F.lit(0))
    return F.get(recent, F.size(recent) - cycle + slot)


def seasonal_naive(series: DataFrame, seasonal_period: int, test_size: int) -> DataFrame:
    """Repeat the last training cycle over the holdout, cyclically if the holdout is longer."""
    rows = compact(series, test_size, seasonal_period).select("series_id", "recent", F.inline("holdout"))
    return rows.select(
        "series_id", "period", "step", "actual", cyclic("recent", seasonal_period, F.col("step")).alias("forecast"))


def model_errors(backtest: DataFrame) -> DataFrame:
    """Errors of the model and of the naive forecast per series, and whether the model has the lower mean absolute one.

    ``beats_naive`` is NULL where there is no model forecast.
    """
    model = forecast_errors(backtest)
    naive = forecast_errors(backtest, forecast="naive").select(
        "series_id", F.col("mae").alias("naive_mae"), F.col("rmse").alias("naive_rmse"))
    return model.join(naive, "series_id").withColumn("beats_naive", F.col("mae") < F.col("naive_mae"))


def forecast_errors(backtest: DataFrame, *keys: str, forecast: str = "forecast") -> DataFrame:
    """Mean absolute and root mean square error over the holdout of each series."""
    error = F.col("actual") - F.col(forecast)
    return backtest.groupBy("series_id", *keys).agg(
        F.avg(F.abs(error)).alias("mae"), F.sqrt(F.avg(error * error)).alias("rmse"))


def backtest_table(backtest: DataFrame) -> DataFrame:
    """Actual, forecast and absolute error per held-out period, rounded half-even to whole units."""
    return backtest.select(
        "series_id", "period",
        F.bround("actual", 0).alias("actual"),
        F.bround("forecast", 0).alias("forecast"),
        F.bround(F.abs(F.col("actual") - F.col("forecast")), 0).alias("abs_error"),
    )
