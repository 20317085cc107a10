"""The nested dashboard document and its parts, each a one-row frame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from basketlens.operators.series import model_errors, train_test_split
from basketlens.sources.tables import finite


def _listed(order: str, **columns: Column) -> list[Column]:
    """Parallel arrays of the columns in ascending order of ``order``; one row per period or segment goes in."""
    rows = F.sort_array(F.collect_list(F.struct(F.col(order).alias("_order"), F.struct(
        *[c.alias(name) for name, c in columns.items()]).alias("_row"))))
    values = F.transform(rows, lambda r: r["_row"])
    return [values[name].alias(name) for name in columns]


def _date(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def forecast_document(series: DataFrame, backtest: DataFrame, grain: str, test_size: int) -> DataFrame:
    """Grain, training history, backtest and errors of one series, in whole units."""
    whole = lambda c: finite(F.bround(F.round(c, 2), 0))  # cents first: sums in another order round alike
    history = train_test_split(series, test_size).filter(~F.col("is_test")).agg(F.struct(
        *_listed("period", period=_date("period"), net_sales=whole("net_sales"))))
    tested = backtest.agg(F.struct(*_listed(
        "period", period=_date("period"), actual=whole("actual"), forecast=whole("forecast"), naive=whole("naive"))))
    errors = model_errors(backtest).select(F.struct(
        whole("mae").alias("model_mae"), whole("rmse").alias("model_rmse"), whole("naive_mae").alias("naive_mae"),
        whole("naive_rmse").alias("naive_rmse"), "beats_naive"))
    row = series.sparkSession.range(1).select(
        F.lit(grain).alias("grain"), history.scalar().alias("history"), tested.scalar().alias("backtest"),
        errors.scalar().alias("errors"))
    return row.select("grain", "history", "backtest", "errors.*")


def _arrays(document: DataFrame, struct: str, section: str, key: str, names: Sequence[str]) -> DataFrame:
    """One row per element of parallel arrays, named by those in ``key``."""
    listed = document.select(F.posexplode(f"{struct}.{key}").alias("position", "key"),
                             *[F.col(f"{struct}.{n}").alias(n) for n in names])
    return reduce(DataFrame.unionByName, [listed.select(
        F.lit(f"{section}.{n}").alias("section"), F.col("key").cast("string").alias("key"), "position",
        F.get(n, F.col("position")).cast("double").alias("value")) for n in names])


def scalar_rows(frame: DataFrame, section: str) -> DataFrame:
    """One row per column of a one-row frame; booleans count as 0 and 1."""
    doubles = frame.select(*[F.col(c).cast("double").alias(c) for c in frame.columns])
    return doubles.unpivot([], frame.columns, "key", "value").select(
        F.lit(section).alias("section"), "key", F.lit(0).alias("position"), "value")


def forecast_rows(document: DataFrame) -> DataFrame:
    """The forecast document as rows: ``section, key, position, value``."""
    errors = document.select("model_mae", "model_rmse", "naive_mae", "naive_rmse", "beats_naive")
    return (_arrays(document, "history", "history", "period", ["net_sales"])
            .unionByName(_arrays(document, "backtest", "backtest", "period", ["actual", "forecast", "naive"]))
            .unionByName(scalar_rows(errors, "errors")))


def dashboard_rows(document: DataFrame) -> DataFrame:
    """The dashboard document as rows: ``section, key, position, value``."""
    figures = [f.name for f in document.schema["segments"].dataType.elementType if f.name != "segment_label"]
    curves = document.select(F.explode("churn.curves").alias("label", "curve")).select("label", "curve.*")
    points = curves.select(F.col("label").alias("key"), "survival", F.posexplode("days").alias("position", "day"))
    parts = [
        scalar_rows(document.select("kpis.*"), "kpis"),
        _arrays(document, "segments", "segments", "segment_label", figures),
        scalar_rows(document.select("churn.threshold_days"), "churn"),
        curves.select(F.lit("churn.n").alias("section"), F.col("label").alias("key"), F.lit(0).alias("position"),
                      F.col("n").cast("double").alias("value")),
        points.select(F.lit("churn.days").alias("section"), "key", "position", F.col("day").cast("double").alias("value")),
        points.select(F.lit("churn.survival").alias("section"), "key", "position", F.get("survival", "position").alias("value")),
        _arrays(document, "cox", "cox", "covariate", ["hazard_ratio", "p"]),
        forecast_rows(document.select("forecast.*")),
    ]
    return reduce(DataFrame.unionByName, parts)


def dashboard_kpis(segments: DataFrame, overview: DataFrame, forecast: DataFrame, threshold_days: int, best: Mapping,
                   naive: Mapping) -> DataFrame:
    """The headline figures: customers, segmentation quality with its bounds, churn and forecast error.

    ``best`` and ``naive`` hold the scores of the chosen fit and of the baseline.
    """
    errors = forecast.select(F.struct("model_mae", "naive_mae", "beats_naive")).scalar()
    three = lambda value: F.bround(F.lit(float(value)), 3)
    row = segments.sparkSession.range(1).select(
        segments.agg(F.count("customer_id")).scalar().alias("total_customers"),
        F.lit(best["k"]).alias("chosen_k"),
        F.lit(bool(best["decided"])).alias("k_decided"),
        three(best["silhouette"]).alias("silhouette_score"),
        three(best["silhouette_low"]).alias("silhouette_low"),
        three(best["silhouette_high"]).alias("silhouette_high"),
        three(naive["silhouette"]).alias("naive_silhouette_score"),
        F.lit(threshold_days).alias("churn_threshold_days"),
        overview.select(F.bround(100 * F.col("event_rate"), 1)).scalar().alias("churn_rate_pct"),
        errors.alias("errors"))
    gain = 100 * (1 - F.col("errors.model_mae") / F.nullif(F.col("errors.naive_mae"), F.lit(0.0)))
    return row.select("*", "errors.*", F.bround(gain, 1).alias("mae_improvement_pct")).drop("errors")


def dashboard_document(kpis: DataFrame, segment_rows: DataFrame, curves: DataFrame, threshold_days: int,
                       hazard_ratios: DataFrame, forecast: DataFrame) -> DataFrame:
    """One row holding everything the dashboard shows."""
    as_struct = lambda df: df.select(F.struct(*df.columns)).scalar()
    figures = F.struct(*[
        (finite(F.col(c)) if kind == "double" else F.col(c)).alias(c) for c, kind in segment_rows.dtypes])
    # Best spenders first, names ascending within a tie.
    best_first = F.array_sort(F.collect_list(figures), lambda a, b: F.when(
        a.avg_monetary != b.avg_monetary, F.when(a.avg_monetary > b.avg_monetary, -1).otherwise(1)
    ).when(a.segment_label < b.segment_label, -1).when(a.segment_label > b.segment_label, 1).otherwise(0))
    curve = F.struct("segment_label", F.struct("n", "days", "survival"))
    ratios = F.struct("covariate", finite(F.col("hazard_ratio")).alias("hazard_ratio"), finite(F.col("p")).alias("p"))
    return kpis.sparkSession.range(1).select(
        as_struct(kpis).alias("kpis"),
        segment_rows.agg(best_first).scalar().alias("segments"),
        F.struct(
            F.lit(threshold_days).alias("threshold_days"),
            curves.agg(F.map_from_entries(F.sort_array(F.collect_list(curve)))).scalar().alias("curves"),
        ).alias("churn"),
        hazard_ratios.agg(F.sort_array(F.collect_list(ratios))).scalar().alias("cox"),
        as_struct(forecast).alias("forecast"),
    )
