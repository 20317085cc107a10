"""The jobs. Each reads stored tables under a root folder and writes its results there.

``load`` and ``append`` raw lines -> tables, ``segment`` -> customer_segments, ``churn`` and ``forecast`` -> report
files, ``dashboard`` -> one JSON document. ``run_all`` runs them in order and computes nothing twice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from basketlens.operators import cleaning, cox, rfm, segmentation as seg, series as ts, survival as sv
from basketlens.operators.activity import customer_activity
from basketlens.operators.forecast import seasonal_arima_forecast
from basketlens.operators.intervals import churn_threshold, purchase_intervals
from basketlens.operators.likelihood import likelihood_forecast
from basketlens.operators.sales import daily_sales
from basketlens.plans import documents as doc
from basketlens.session import materialize, scratch
from basketlens.sources import tables as store
from basketlens.sources.raw import read_raw

Tables = Mapping[str, DataFrame]


@dataclass
class Segmentation:
    segments: DataFrame
    search: list[dict]
    best: dict
    naive: dict

    @property
    def beats_naive(self) -> bool:
        return self.best["silhouette"] > self.naive["silhouette"]


@dataclass
class Churn:
    threshold_days: int
    survival: DataFrame
    curves: DataFrame
    medians: DataFrame
    test: DataFrame
    reference: str

    def summary(self) -> DataFrame:
        """Fit the Cox model and return its summary."""
        design = materialize(cox.cox_design(self.survival, self.reference), "cox-design")
        return cox.cox_summary(cox.cox_ph(design))


@dataclass
class Forecast:
    grain: str
    test_size: int
    series: DataFrame
    backtest: DataFrame
    choice: dict = field(default_factory=dict)

    @property
    def document(self) -> DataFrame:
        return doc.forecast_document(self.series, self.backtest, self.grain, self.test_size)


def _cleaned(spark: SparkSession, raw_path: str | list[str], **read_options) -> tuple[DataFrame, Tables, Tables]:
    """Cleaned lines, the four tables and the mergeable states. The stored lines are columnar: each reads its own few columns."""
    cleaned = materialize(cleaning.clean(read_raw(spark, raw_path, **read_options)), "clean-lines")
    tables = cleaning.tables_from(cleaned)
    states = {
        "customer_countries": cleaning.customer_countries(cleaned),
        "product_descriptions": cleaning.product_descriptions(cleaned),
        "customer_activity": customer_activity(tables["invoices"], tables["invoice_items"]),
    }
    return cleaned, tables, states


def load(spark: SparkSession, raw_path: str | list[str], root: str, buckets: int | None = None, **read_options) -> dict[str, int]:
    """Parse the raw file once, build the four tables from the stored lines, publish them together if they are sound."""
    with scratch(spark):
        _, tables, states = _cleaned(spark, raw_path, **read_options)
        store.write_tables(tables, root, buckets, states)
    return {name: df.count() for name, df in store.read_tables(spark, root).items()}


def append(spark: SparkSession, raw_path: str | list[str], root: str, **read_options) -> dict[str, int]:
    """Add the lines of a further file to the current load; its invoices must be new."""
    with scratch(spark):
        _, tables, states = _cleaned(spark, raw_path, **read_options)
        store.append_tables(tables, states, root)
    return {name: df.count() for name, df in store.read_tables(spark, root).items()}


def collapsed(tables: Tables) -> Tables:
    """The tables with the lines summed per invoice, for a run of several analyses."""
    return {**tables, "invoice_items": rfm.collapse_lines(tables["invoice_items"])}


def segment(tables: Tables, ks: Sequence[int] = seg.K_RANGE, restarts: int = seg.RESTARTS, seed: int = seg.SEED,
            given: Mapping[int, Sequence[Sequence[float]]] | None = None, settle: bool = True) -> Segmentation:
    """RFM features, the best k-means clustering by silhouette, named clusters, and the naive baseline.

    ``given`` centroids by k are scored as they are, in place of a fit. With ``settle`` scores are refined until it is
    certain which labelling is the best; without, one grid gives bounds."""
    features = materialize(rfm.rfm_features(tables["invoices"], tables["invoice_items"]), "rfm")
    scaled = materialize(seg.scaled_features(features), "scaled")
    search, naive = seg.kmeans_search(scaled, ks, restarts, seed, "naive_monetary_quintile", given, settle=settle)
    best = seg.best_of(search)
    assigned = seg.kmeans_assign(scaled, best["centroids"]).drop(*seg.SCALED)
    named = seg.segment_labels(assigned, rfm.rfm_medians(features).first())
    columns = [*features.columns, "segment", "segment_label"]
    return Segmentation(materialize(named.select(columns), "segments"), search, best, naive)


def churn(tables: Tables, segments: DataFrame, reference: str = seg.CHAMPIONS,
          home_country: str = sv.HOME_COUNTRY) -> Churn:
    """Threshold from the purchase gaps, survival per segment, log-rank test; the Cox model on request."""
    threshold = churn_threshold(purchase_intervals(tables["invoices"])).first()["churn_threshold_days"]
    lifecycle = materialize(
        sv.customer_lifecycle(tables["invoices"], tables["invoice_items"], tables["customers"]), "lifecycle")
    survival = materialize(sv.survival_frame(lifecycle, segments, threshold, home_country), "survival")
    curves = sv.km_confidence(sv.km_curves(survival))
    return Churn(threshold, survival, curves, sv.km_median(curves), sv.logrank_test(sv.logrank(survival)), reference)


def forecast(tables: Tables, grain: str | None = None, likelihood: bool = True) -> Forecast:
    """Total net sales at the cleaner grain, or the given one, with a backtest on the latest periods.

    The model is fitted by exact likelihood, or by conditional least squares."""
    sales = daily_sales(tables["invoices"], tables["invoice_items"])
    dense = materialize(ts.trim_partial_periods(ts.daily_sales_dense(sales)), "daily")
    if grain is None:
        choice = ts.choose_granularity(dense).first().asDict()
    else:
        choice = {"grain": grain, "seasonal_period": ts.SEASONAL_PERIOD[grain], "test_size": ts.HOLDOUT[grain]}
    grain, period, size = choice["grain"], choice["seasonal_period"], choice["test_size"]
    series = materialize(ts.RESAMPLE[grain](dense), grain)
    model = likelihood_forecast if likelihood else seasonal_arima_forecast
    return Forecast(grain, size, series, model(series, period, size), choice)


def kpis(segmentation: Segmentation, lapsed: Churn, sales: Forecast, document: DataFrame | None = None) -> DataFrame:
    """The headline figures of the three analyses."""
    return doc.dashboard_kpis(
        segmentation.segments, sv.churn_overview(lapsed.survival), document or sales.document,
        lapsed.threshold_days, segmentation.best, segmentation.naive)


def dashboard(segmentation: Segmentation, lapsed: Churn, sales: Forecast, ratios: DataFrame | None = None) -> DataFrame:
    """The one-row document; ``ratios`` may come from a stored Cox summary."""
    forecast_row = materialize(sales.document, "forecast-document")
    if ratios is None:
        ratios = cox.cox_hazard_ratios(lapsed.summary())
    return doc.dashboard_document(
        kpis(segmentation, lapsed, sales, forecast_row), seg.segment_summary(segmentation.segments),
        sv.km_document(lapsed.curves), lapsed.threshold_days, ratios, forecast_row)


SILHOUETTE = "labelling string, silhouette double, silhouette_low double, silhouette_high double, points bigint"


def write_segmentation(result: Segmentation, folder: str) -> None:
    """Store segments and scores; parts made of segments stored before are stale from now on, and their reports go."""
    spark = result.segments.sparkSession
    for report in ("cox_model_summary", "km_curves", "km_medians", "logrank_test", "dashboard_data"):
        store.drop(spark, f"{folder}/reports/{report}")
    store.write_segments(result.segments, folder)
    scores = spark.createDataFrame(seg.search_rows(result.search), seg.SEARCH)
    store.write_report(scores.orderBy("k"), f"{folder}/reports/silhouette_by_k")
    naive = [tuple(result.naive[f.split()[0]] for f in SILHOUETTE.split(", "))]
    store.write_report(spark.createDataFrame(naive, SILHOUETTE), f"{folder}/reports/silhouette_naive")
    store.write_report(seg.segment_profile(result.segments).orderBy("segment"), f"{folder}/reports/segment_profile")


def read_segmentation(spark: SparkSession, folder: str) -> Segmentation:
    """The stored segments with their scores, as ``write_segmentation`` left them."""
    search = [row.asDict() for row in
              store.read_report(spark, f"{folder}/reports/silhouette_by_k", seg.SEARCH).orderBy("k").collect()]
    naive = store.read_report(spark, f"{folder}/reports/silhouette_naive", SILHOUETTE).first().asDict()
    return Segmentation(store.read_segments(spark, folder), search, seg.best_of(search), naive)


def write_churn(result: Churn, folder: str, home_country: str = sv.HOME_COUNTRY) -> DataFrame:
    """Write the churn reports, and what the dashboard needs of them as parts; returns the Cox summary."""
    spark = result.survival.sparkSession
    summary = result.summary()
    store.write_report(summary, f"{folder}/reports/cox_model_summary")
    store.write_report(result.curves.orderBy(sv.GROUP, "duration"), f"{folder}/reports/km_curves")
    store.write_report(result.medians.orderBy(sv.GROUP), f"{folder}/reports/km_medians")
    store.write_report(result.test, f"{folder}/reports/logrank_test")
    made_from = churn_inputs(spark, folder, home_country)
    overview = sv.churn_overview(result.survival).withColumn("threshold_days", F.lit(result.threshold_days))
    store.write_part(overview, folder, "churn_overview", **made_from)
    store.write_part(sv.km_document(result.curves), folder, "churn_curves", **made_from)
    store.write_part(cox.cox_hazard_ratios(summary), folder, "hazard_ratios", **made_from)
    return summary


def churn_inputs(spark: SparkSession, folder: str, home_country: str) -> dict[str, str]:
    """What the churn parts depend on besides the load, whose folder they lie in."""
    return {"segments": store.segments_version(spark, folder), "home_country": home_country}


def write_forecast(result: Forecast, folder: str) -> None:
    """The backtest of the model, its errors against the naive forecast with the verdict, and the forecast document."""
    table = ts.backtest_table(result.backtest).orderBy("period")
    store.write_report(table.select("period", "actual", "forecast", "abs_error"),
                       f"{folder}/reports/sales_forecast_backtest")
    store.write_report(ts.model_errors(result.backtest), f"{folder}/reports/sales_forecast_errors")
    store.write_part(result.document, folder, "forecast_document")


def stored_dashboard(spark: SparkSession, folder: str, home_country: str = sv.HOME_COUNTRY) -> DataFrame:
    """The document from stored parts alone: none is computed again, and one that no longer fits the others is refused."""
    made_from = churn_inputs(spark, folder, home_country)
    segmentation = read_segmentation(spark, folder)
    overview = store.read_part(spark, folder, "churn_overview", "churn", **made_from)
    curves = store.read_part(spark, folder, "churn_curves", "churn", **made_from)
    ratios = store.read_part(spark, folder, "hazard_ratios", "churn", **made_from)
    forecast_row = store.read_part(spark, folder, "forecast_document", "forecast")
    threshold = overview.first()["threshold_days"]
    figures = doc.dashboard_kpis(segmentation.segments, overview, forecast_row, threshold, segmentation.best, segmentation.naive)
    return doc.dashboard_document(figures, seg.segment_summary(segmentation.segments), curves, threshold, ratios, forecast_row)


def write_dashboard(spark: SparkSession, root: str, home_country: str = sv.HOME_COUNTRY) -> DataFrame:
    """The document from what the jobs have stored for the current load; they have to be run before."""
    folder = store.current(spark, root)
    document = stored_dashboard(spark, folder, home_country)
    store.write_document(document, f"{folder}/reports/dashboard_data")
    return spark.read.schema(document.schema).json(f"{folder}/reports/dashboard_data")


def run_all(spark: SparkSession, root: str, raw_path: str | list[str] | None = None, ks: Sequence[int] = seg.K_RANGE,
            restarts: int = seg.RESTARTS, home_country: str = sv.HOME_COUNTRY, buckets: int | None = None) -> DataFrame:
    """Every job in order; returns the dashboard document, also written below ``root``."""
    if raw_path is not None:
        load(spark, raw_path, root, buckets)
    folder = store.current(spark, root)
    with scratch(spark):
        tables = collapsed(store.read_tables(spark, root))
        write_segmentation(segment(tables, ks, restarts), folder)
        write_churn(churn(tables, store.read_segments(spark, folder), home_country=home_country), folder, home_country)
        write_forecast(forecast(tables), folder)
    return write_dashboard(spark, root, home_country)
