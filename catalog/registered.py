"""One registered query per operator. Each runs over the whole tables of the folder it is given.

Money and scores leave as doubles rounded to a fixed number of places, so that two engines that add
in a different order agree. Where labels are needed, the spend quintiles stand in for k-means
clusters (whose numbering and borders depend on the engine): "Quintile 1" .. "Quintile 5".
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from basketlens.functions.scalars import signed_log
from basketlens.operators import activity, audits, cleaning, cox, forecast as fc, intervals, rfm, sales, segmentation as seg
from basketlens.operators import likelihood as lk, quantiles as qt, series as ts, survival as sv
from basketlens.operators.silhouette import exact_silhouettes, silhouette as silhouette_of, silhouettes
from basketlens.plans import documents, jobs
from basketlens.session import materialize, scratch_path, ship_package
from basketlens.sources import raw as raw_source, sql, tables as store
from catalog.star_schema import load

HOME = "NATION_0"
REFERENCE = "Quintile 5"
# Centroids by k that stand in for fits, so that SQL can follow the choice of k; spread along a line.
GIVEN = {k: [[-1.2 + 2.6 * i / (k - 1), 1.1 - 2.2 * i / (k - 1) + 0.3 * (i % 2), 0.8 - 1.9 * i / (k - 1)] for i in range(k)]
         for k in seg.K_RANGE}
COEFFICIENTS = (0.3, -0.4, -0.5)  # phi, PHI and theta at which SQL follows the likelihood
QUANTILES = [0.0, 0.1, 0.5, 0.9, 0.99, 1.0]
CENTROIDS = [[-0.8, 0.9, 0.6], [0.1, 0.0, 0.2], [1.5, -1.2, -0.7], [0.4, -2.5, -4.0]]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


class Shop:
    """The retail tables of one folder and the frames built on them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        ship_package(spark)
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in ("invoices", "invoice_items", "customers", "products", "raw_lines"):
            raise AttributeError(name)
        return load(self.spark, self.sf_dir, name)

    @property
    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in store.SCHEMAS}

    @property
    def raw(self) -> DataFrame:
        return self.raw_lines.withColumnRenamed("CustomerID", "Customer ID")

    @property
    def typed(self) -> DataFrame:
        return raw_source.type_raw(self.raw)

    @property
    def cleaned(self) -> DataFrame:
        return cleaning.clean(self.typed)

    @cached_property
    def invoice_totals(self) -> DataFrame:
        """Lines summed per invoice: for queries that need both features and lifecycles."""
        return rfm.collapse_lines(self.invoice_items)

    def rfm(self, items: DataFrame | None = None) -> DataFrame:
        return rfm.rfm_features(self.invoices, self.invoice_items if items is None else items)

    def clustered(self) -> DataFrame:
        quintile = F.col("naive_monetary_quintile")
        return materialize(self.rfm().withColumn("segment", quintile), "clustered")

    def named(self) -> DataFrame:
        clustered = self.clustered()
        return seg.segment_labels(clustered, rfm.rfm_medians(clustered).first())

    def scaled(self) -> DataFrame:
        return materialize(seg.scaled_features(self.clustered()), "scaled")

    def quintiles(self) -> DataFrame:
        label = F.concat(F.lit("Quintile "), F.col("naive_monetary_quintile").cast("string"))
        return self.rfm(self.invoice_totals).select("customer_id", label.alias("segment_label"))

    def survival(self) -> DataFrame:
        threshold = intervals.churn_threshold(intervals.purchase_intervals(self.invoices)).first()[1]
        lifecycle = materialize(sv.customer_lifecycle(self.invoices, self.invoice_totals, self.customers), "lifecycle")
        return sv.survival_frame(lifecycle, self.quintiles(), threshold, HOME)

    def design(self) -> DataFrame:
        return cox.cox_design(materialize(self.survival(), "survival"), REFERENCE)

    def dense(self) -> DataFrame:
        return ts.daily_sales_dense(sales.daily_sales(self.invoices, self.invoice_items))

    def trimmed(self) -> DataFrame:
        return ts.trim_partial_periods(self.dense())

    def series(self, grain: str) -> DataFrame:
        return ts.RESAMPLE[grain](self.trimmed())

    def by_country(self) -> DataFrame:
        daily = sales.daily_sales_by(self.invoices, self.invoice_items, "country", self.customers, "customer_id")
        return ts.monthly_resample(ts.trim_partial_periods(ts.daily_sales_dense(daily)))

    def histories(self) -> DataFrame:
        """Monthly series per country and in total, whole and cut to the last two years."""
        every = materialize(self.by_country().unionByName(self.series("monthly")), "series")
        newest = F.row_number().over(ts.whole().orderBy(F.col("period").desc()))
        cut = every.withColumn("_newest", newest).filter("_newest <= 24").select(
            F.concat("series_id", F.lit(" 24")).alias("series_id"), "period", "net_sales")
        return every.unionByName(cut)

    def backtest(self) -> DataFrame:
        """Model and naive forecasts of these series."""
        return fc.seasonal_arima_forecast(self.histories(), 12, 3)


def query(places: int | None = 6):
    """Register under the function's name, with doubles rounded and decimals turned into doubles."""
    def register(build: Callable[[Shop], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(build(Shop(spark, sf_dir)), places)
        run.__doc__ = build.__doc__
        QUERIES[build.__name__] = run
        return build
    return register


def rounded(df: DataFrame, places: int | None) -> DataFrame:
    def out(f: T.StructField):
        if isinstance(f.dataType, T.DecimalType):
            return F.col(f"`{f.name}`").cast("double").alias(f.name)
        if isinstance(f.dataType, T.DoubleType) and places is not None:
            return F.round(F.col(f"`{f.name}`"), places).alias(f.name)
        return F.col(f"`{f.name}`")
    return df.select(*[out(f) for f in df.schema])


# --- sources -------------------------------------------------------------------------------------

@query()
def union_sheets(shop: Shop) -> DataFrame:
    lines = shop.raw_lines
    first = F.col("InvoiceDate") < F.lit("1998-01-01").cast("timestamp_ntz")
    return raw_source.union_sheets([lines.filter(first), lines.filter(~first).select(*reversed(lines.columns))])


@query()
def read_raw(shop: Shop) -> DataFrame:
    """Write the raw lines as CSV to the shared folder, then scan and type that file."""
    path = scratch_path(shop.spark, "raw-csv")
    text = shop.raw.withColumn("Description", F.coalesce("Description", F.lit("NA")))
    text.write.option("header", True).option("escape", '"').options(
        timestampNTZFormat="yyyy-MM-dd HH:mm:ss", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    typed = raw_source.read_raw(shop.spark, path, schema=raw_source.RAW_SCHEMA)
    return typed.withColumnRenamed("Customer ID", "customer_id")


@query()
def read_cached_summary(shop: Shop) -> DataFrame:
    """Store the log-rank table as a report and read it back with renamed, rounded columns."""
    path = scratch_path(shop.spark, "report")
    store.write_report(sv.logrank(materialize(shop.survival(), "survival")).drop("covariance"), path)
    back = store.read_report(shop.spark, path, "segment_label string, observed bigint, expected double")
    return back.select(F.col("segment_label").alias("segment"), "observed", F.round("expected", 4).alias("expected"))


@query()
def segment_table_scan(shop: Shop) -> DataFrame:
    """Replace the stored segment table, then scan it."""
    root = scratch_path(shop.spark, "store")
    store.write_segments(shop.named(), root)
    return store.read_segments(shop.spark, root).select("customer_id", "segment_label")


# --- cleaning and normalisation ------------------------------------------------------------------

@query()
def drop_missing_keys(shop: Shop) -> DataFrame:
    return cleaning.drop_missing_keys(shop.raw).withColumnRenamed("Customer ID", "customer_id")


@query()
def trim_codes(shop: Shop) -> DataFrame:
    return cleaning.trim_codes(cleaning.drop_missing_keys(shop.raw)).select("Invoice", "StockCode", "Quantity")


@query()
def parse_dates(shop: Shop) -> DataFrame:
    text = shop.raw.withColumn("InvoiceDate", F.date_format("InvoiceDate", "yyyy-MM-dd HH:mm:ss"))
    return cleaning.parse_dates(text).select("Invoice", "StockCode", "InvoiceDate")


@query()
def flag_cancellations(shop: Shop) -> DataFrame:
    return shop.cleaned.select("Invoice", "StockCode", "Quantity", "is_cancellation")


@query()
def customers_dim(shop: Shop) -> DataFrame:
    return cleaning.customers_dim(shop.cleaned)


@query()
def products_dim(shop: Shop) -> DataFrame:
    return cleaning.products_dim(shop.cleaned)


@query()
def invoices_dim(shop: Shop) -> DataFrame:
    return cleaning.invoices_dim(shop.cleaned)


@query()
def invoice_items_fact(shop: Shop) -> DataFrame:
    return cleaning.invoice_items_fact(shop.cleaned)


@query()
def line_totals(shop: Shop) -> DataFrame:
    return cleaning.line_totals(cleaning.invoice_items_fact(shop.cleaned))


@query()
def guest_lines(shop: Shop) -> DataFrame:
    return cleaning.guest_lines(shop.invoices, shop.invoice_items)


@query()
def load_counts(shop: Shop) -> DataFrame:
    return cleaning.load_counts(shop.typed)


@query(places=4)
def appended_rfm(shop: Shop) -> DataFrame:
    """Features from the merged states of a load and an append, each of half the invoices."""
    root, half = scratch_path(shop.spark, "appended"), F.pmod(F.xxhash64("invoice_no"), F.lit(2))
    counts = {"customer_countries": shop.customers.withColumn("n", F.lit(1).cast("bigint")),
              "product_descriptions": shop.products.withColumn("n", F.lit(1).cast("bigint"))}
    parts = []
    for i in range(2):
        facts = {n: getattr(shop, n).where(half == i) for n in store.BUCKETED}
        parts.append(({**shop.tables, **facts}, {**counts, "customer_activity": activity.customer_activity(*facts.values())}))
    store.write_tables(parts[0][0], root, states=parts[0][1])
    folder = store.append_tables(*parts[1], root)
    state, invoices = (store.read_table(shop.spark, folder, n) for n in ("customer_activity", "invoices"))
    return rfm.features_of(activity.rfm_of(state), invoices)


@query(places=4)
def exact_quantiles(shop: Shop) -> DataFrame:
    """Quantiles of recency, frequency and spend, and of the gaps between purchases, by narrowing ranges."""
    features = materialize(shop.rfm(), "features")
    gaps = materialize(intervals.purchase_intervals(shop.invoices), "gaps")
    found = {**qt.exact_quantiles(features, {c: QUANTILES for c in seg.FEATURES}),
             **qt.exact_quantiles(gaps, {"days_since_prev_purchase": QUANTILES})}
    rows = [(c, q, float(v)) for c, values in found.items() for q, v in zip(QUANTILES, values)]
    return shop.spark.createDataFrame(rows, "column string, quantile double, value double")


def _in_sql(shop: Shop, statement: str) -> DataFrame:
    """A statement over the views and table functions of the shop."""
    sql.register(shop.spark, shop.tables)
    return shop.spark.sql(statement)


@query(places=4)
def sql_customers_of(shop: Shop) -> DataFrame:
    """A table function with a parameter, in a join."""
    return _in_sql(shop, f"select c.country, f.customer_id, f.frequency, f.monetary from customers_of('{HOME}') f "
                         "join customers c on c.customer_id = f.customer_id")


@query(places=4)
def sql_sales_between(shop: Shop) -> DataFrame:
    return _in_sql(shop, "select sales_month, net_sales from sales_between(date'1996-03-15', date'1997-06-30')")


@query(places=4)
def sql_churn_threshold(shop: Shop) -> DataFrame:
    """The threshold at two quantiles, one by default, and the purchases of one customer."""
    return _in_sql(shop, "select 0.9D as quantile, * from churn_threshold() union all select 0.5, * from churn_threshold(0.5) "
                         "union all select -1, count(*), count(days_since_prev_purchase) from purchases_of(7)")


@query()
def audit_primary_keys(shop: Shop) -> DataFrame:
    return audits.audit_primary_keys(shop.tables)


@query()
def audit_foreign_keys(shop: Shop) -> DataFrame:
    return audits.audit_foreign_keys(shop.tables)


@query()
def audit_not_null(shop: Shop) -> DataFrame:
    return audits.audit_not_null(shop.tables)


# --- joins and aggregates ------------------------------------------------------------------------

@query()
def invoice_revenue(shop: Shop) -> DataFrame:
    return rfm.invoice_revenue(shop.invoices, shop.invoice_items)


@query()
def rfm_features(shop: Shop) -> DataFrame:
    return shop.rfm().orderBy("customer_id")


@query()
def snapshot_date(shop: Shop) -> DataFrame:
    """Both snapshot dates: over all invoices, and over customers' purchases with lines."""
    last = sv.lifecycle_aggregates(shop.invoices, shop.invoice_items).agg(
        (F.max("last_purchase_date") + F.expr("interval 1 day")).alias("d"))
    return rfm.snapshot_date(shop.invoices).withColumn("survival_snapshot_date", last.scalar())


@query()
def monetary_quintile(shop: Shop) -> DataFrame:
    return shop.rfm().select("customer_id", "naive_monetary_quintile")


@query()
def rfm_medians(shop: Shop) -> DataFrame:
    return rfm.rfm_medians(materialize(shop.rfm(), "rfm"))


@query()
def monthly_sales(shop: Shop) -> DataFrame:
    return sales.monthly_sales(shop.invoices, shop.invoice_items).orderBy("period")


@query()
def daily_sales(shop: Shop) -> DataFrame:
    return sales.daily_sales(shop.invoices, shop.invoice_items).orderBy("day")


@query(places=4)
def daily_sales_dense(shop: Shop) -> DataFrame:
    return shop.dense()


@query(places=4)
def weekly_sales(shop: Shop) -> DataFrame:
    return shop.series("weekly")


@query(places=4)
def monthly_resample(shop: Shop) -> DataFrame:
    return shop.series("monthly")


@query(places=4)
def country_monthly_sales(shop: Shop) -> DataFrame:
    return shop.by_country()


@query()
def customer_lifecycle(shop: Shop) -> DataFrame:
    return sv.customer_lifecycle(shop.invoices, shop.invoice_items, shop.customers)


@query()
def lifecycle_aggregates(shop: Shop) -> DataFrame:
    return sv.lifecycle_aggregates(shop.invoices, shop.invoice_items)


@query()
def purchase_intervals(shop: Shop) -> DataFrame:
    return intervals.purchase_intervals(shop.invoices).orderBy("customer_id", "invoice_date")


@query()
def churn_threshold(shop: Shop) -> DataFrame:
    return intervals.churn_threshold(intervals.purchase_intervals(shop.invoices))


# --- series and forecasts ------------------------------------------------------------------------

@query(places=4)
def trim_partial_periods(shop: Shop) -> DataFrame:
    return shop.trimmed()


def _decomposed(shop: Shop, column: str) -> DataFrame:
    parts = [
        ts.decompose(shop.series(grain), ts.SEASONAL_PERIOD[grain]).select(F.lit(grain).alias("grain"), "period", column)
        for grain in ("weekly", "monthly")
    ]
    return parts[0].unionByName(parts[1])


@query(places=4)
def decompose_trend(shop: Shop) -> DataFrame:
    return _decomposed(shop, "trend")


@query(places=3)
def decompose_seasonal(shop: Shop) -> DataFrame:
    return _decomposed(shop, "seasonal")


@query(places=3)
def decompose_residual(shop: Shop) -> DataFrame:
    return _decomposed(shop, "resid")


@query(places=8)
def residual_noise_fraction(shop: Shop) -> DataFrame:
    parts = [
        ts.residual_noise_fraction(shop.series(grain), ts.SEASONAL_PERIOD[grain]).withColumn("grain", F.lit(grain))
        for grain in ("weekly", "monthly")
    ]
    return parts[0].unionByName(parts[1])


@query(places=8)
def choose_granularity(shop: Shop) -> DataFrame:
    return ts.choose_granularity(materialize(shop.trimmed(), "daily"))


@query(places=4)
def train_test_split(shop: Shop) -> DataFrame:
    return ts.train_test_split(shop.series("weekly"), 12).select("period", "net_sales", "is_test", "step")


@query(places=4)
def recent_history(shop: Shop) -> DataFrame:
    return ts.recent_history(shop.series("monthly"), 3)


@query(places=4)
def seasonal_naive(shop: Shop) -> DataFrame:
    monthly = ts.seasonal_naive(shop.by_country(), 12, 3)
    weekly = ts.seasonal_naive(shop.series("weekly"), 52, 12)
    return monthly.unionByName(weekly)


@query(places=2)
def forecast_errors(shop: Shop) -> DataFrame:
    """Errors of the model and of the naive forecast, and the verdict, per series."""
    return ts.model_errors(shop.backtest())


@query(places=4)
def backtest_table(shop: Shop) -> DataFrame:
    """Actual and model forecast in whole units."""
    rows = shop.backtest().withColumns({"actual": F.round("actual", 4), "forecast": F.round("forecast", 1)})
    return ts.backtest_table(rows)


@query(places=4)
def arima_differences(shop: Shop) -> DataFrame:
    return fc.arima_differences(shop.series("monthly"), 12).select("period", "net_sales", "w", "w_1", "w_m", "w_m1")


@query(places=6)
def arima_normal_equations(shop: Shop) -> DataFrame:
    """Sums of the first regression, over all series, in units of 1e6 per term."""
    millions = shop.by_country().withColumn("net_sales", F.col("net_sales") / 1e6)
    sums = fc.arima_differences(millions, 12).groupBy("series_id").agg(*fc.normal_equations(fc.LONG, "long"))
    return sums.select(
        "series_id", "long_rows",
        *[F.col("long_gram")[i].alias(f"gram_{i}") for i in range(25)],
        *[F.col("long_moment")[i].alias(f"moment_{i}") for i in range(5)])


@query(places=4)
def seasonal_arima_forecast(shop: Shop) -> DataFrame:
    """Holdout forecasts of one monthly series per country, of the total, and of each cut to its last 24 months."""
    return shop.backtest().withColumn("forecast", F.round("forecast", 0))


@query(places=4)
def arima_likelihood(shop: Shop) -> DataFrame:
    """Exact likelihood of every series at given coefficients, and the forecasts there; shocks in millions."""
    at = lk.likelihood_at(shop.histories(), 12, 3, COEFFICIENTS)
    return at.select("series_id", "rows", "loglik", (F.col("variance") / 1e12).alias("variance"),
                     *[F.round(F.get("ahead", h), 0).alias(f"forecast_{h + 1}") for h in range(3)])


@query()
def likelihood_forecast(shop: Shop) -> DataFrame:
    """The fit itself: every series has one, not less likely than the least-squares one or the given coefficients."""
    histories = materialize(shop.histories(), "histories")
    fits = lk.fit_likelihood(histories, 12, 3)
    given = lk.likelihood_at(histories, 12, 3, COEFFICIENTS).select("series_id", F.col("loglik").alias("given"))
    slack = 1e-6
    return fits.join(given, "series_id").select(
        "series_id", "rows", (F.col("loglik") >= F.col("least_squares_loglik") - slack).alias("above_least_squares"),
        (F.col("loglik") >= F.col("given") - slack).alias("above_given"), (F.size("ahead") == 3).alias("forecast"))


@query()
def forecast_document(shop: Shop) -> DataFrame:
    """The document of the monthly series as rows."""
    return documents.forecast_rows(materialize(jobs.forecast(shop.tables, "monthly", likelihood=False).document, "forecast-document"))


# --- segmentation --------------------------------------------------------------------------------

@query(places=8)
def signed_log_features(shop: Shop) -> DataFrame:
    return shop.rfm().select(
        "customer_id", F.log1p(F.col("frequency").cast("double")).alias("log_frequency"),
        signed_log(F.col("monetary").cast("double")).alias("signed_log_monetary"))


@query(places=6)
def scaled_features(shop: Shop) -> DataFrame:
    return shop.scaled().select("customer_id", *seg.SCALED)


@query()
def kmeans_assign(shop: Shop) -> DataFrame:
    return seg.kmeans_assign(shop.scaled(), CENTROIDS).select("customer_id", "segment")


@query()
def kmeans_segments(shop: Shop) -> DataFrame:
    """The full search, ten starts for each k; what the chosen fit has to fulfil, as one row."""
    scaled = shop.scaled()
    best = seg.best_of(seg.kmeans_search(scaled)[0])
    return seg.kmeans_invariants(scaled, best["centroids"], best["cost"], GIVEN[best["k"]])


@query(places=6)
def choose_k(shop: Shop) -> DataFrame:
    """Scores of given centroids for each k, with the choice and whether the bounds decide it."""
    return seg.choose_k(shop.scaled(), given=GIVEN, settle=False)


@query()
def choose_k_decided(shop: Shop) -> DataFrame:
    """The choice among the given centroids, refined until it is certain; SQL scores all pairs."""
    rows = seg.choose_k(shop.scaled(), given=GIVEN)
    return rows.select("k", "chosen", "decided", (F.col("silhouette_low") <= F.col("silhouette_high")).alias("bounded"))


@query(places=6)
def silhouette_exact(shop: Shop) -> DataFrame:
    """Euclidean silhouette over all pairs: of the spend quintiles and of the labels that given centroids make."""
    labelled = seg.kmeans_assign(shop.scaled().withColumnRenamed("segment", "quintile"), CENTROIDS)
    return exact_silhouettes(labelled, seg.SCALED, ["quintile", "segment"]).select("labelling", "silhouette", "points")


@query()
def fitted_segments(shop: Shop) -> DataFrame:
    """The whole chain on fitted clusters: all customers named, the choice certain, better than quintiles."""
    result = jobs.segment(jobs.collapsed(shop.tables))
    named = result.segments.agg(F.count("segment_label").alias("named"))
    return named.select("named", F.lit(result.best["decided"]).alias("decided"), F.lit(result.beats_naive).alias("beats_naive"))


@query(places=6)
def silhouette(shop: Shop) -> DataFrame:
    """Euclidean silhouette of the spend quintiles, with its bounds."""
    return silhouette_of(shop.scaled(), seg.SCALED, "segment")


@query(places=6)
def silhouette_within_bounds(shop: Shop) -> DataFrame:
    """The bounds, which hold the score over all pairs; SQL computes that score."""
    return silhouette_of(shop.scaled(), seg.SCALED, "segment").select(
        "silhouette_low", "silhouette_high", F.lit(True).alias("within"))


@query(places=6)
def silhouette_squared(shop: Shop) -> DataFrame:
    return seg.silhouette_squared(shop.scaled())


@query(places=6)
def naive_quintile_silhouette(shop: Shop) -> DataFrame:
    """Score of the quintiles against that of the given centroids, and whether the centroids win."""
    labelled = seg.kmeans_assign(shop.scaled(), CENTROIDS)
    scores = silhouettes(labelled, seg.SCALED, ["segment", "naive_monetary_quintile"])
    of = lambda name, column="silhouette": F.max(F.when(F.col("labelling") == name, F.col(column)))
    return scores.agg(
        of("segment").alias("clustered"), of("naive_monetary_quintile").alias("naive"),
        (of("segment") > of("naive_monetary_quintile")).alias("beats_naive"),
        ((of("segment", "silhouette_low") > of("naive_monetary_quintile", "silhouette_high"))
         | (of("segment", "silhouette_high") < of("naive_monetary_quintile", "silhouette_low"))).alias("decided"))


@query(places=4)
def cluster_centroids(shop: Shop) -> DataFrame:
    return seg.cluster_centroids(shop.clustered())


@query()
def segment_labels(shop: Shop) -> DataFrame:
    return shop.named().select("customer_id", "segment", "segment_label")


@query()
def segment_profile(shop: Shop) -> DataFrame:
    return seg.segment_profile(shop.named())


@query()
def segment_summary(shop: Shop) -> DataFrame:
    return seg.segment_summary(shop.named())


@query(places=8)
def segment_share(shop: Shop) -> DataFrame:
    return seg.segment_share(shop.named())


# --- survival ------------------------------------------------------------------------------------

@query(places=8)
def survival_frame(shop: Shop) -> DataFrame:
    return shop.survival()


@query(places=8)
def churn_overview(shop: Shop) -> DataFrame:
    return sv.churn_overview(shop.survival())


@query(places=8)
def km_curves(shop: Shop) -> DataFrame:
    return sv.km_curves(shop.survival()).drop("greenwood")


@query(places=8)
def km_confidence(shop: Shop) -> DataFrame:
    return sv.km_confidence(sv.km_curves(shop.survival())).select("segment_label", "duration", "lower", "upper")


@query()
def km_median(shop: Shop) -> DataFrame:
    return sv.km_median(sv.km_curves(shop.survival()))


@query()
def km_document(shop: Shop) -> DataFrame:
    """Days and survival of each curve, as text so that any client compares them alike."""
    document = sv.km_document(sv.km_curves(shop.survival()))
    text = lambda c, kind: F.array_join(F.col(c).cast(f"array<{kind}>").cast("array<string>"), " ").alias(c)
    return document.select("segment_label", "n", text("days", "int"), text("survival", "decimal(5,4)"))


@query(places=6)
def logrank(shop: Shop) -> DataFrame:
    """Observed, expected and covariance, one row per pair of segments."""
    table = sv.logrank(materialize(shop.survival(), "survival"))
    return table.select("segment_label", "observed", "expected", F.posexplode("covariance").alias("other", "covariance"))


@query(places=6)
def logrank_test(shop: Shop) -> DataFrame:
    return sv.logrank_test(sv.logrank(materialize(shop.survival(), "survival")))


@query(places=8)
def cox_design(shop: Shop) -> DataFrame:
    return shop.design()


@query(places=5)
def cox_newton_step(shop: Shop) -> DataFrame:
    """Log likelihood, gradient and information at zero, one column per entry."""
    design = shop.design()
    p = len(cox.covariates_of(design))
    return cox.cox_newton_step(design).select(
        "log_likelihood", *[F.col("gradient")[i].alias(f"g{i}") for i in range(p)],
        *[F.col("information")[n].alias(f"h{i}{j}") for n, (i, j) in enumerate(cox._pairs(p))])


@query(places=6)
def cox_ph(shop: Shop) -> DataFrame:
    return cox.cox_ph(materialize(shop.design(), "design")).drop("steps")


@query(places=6)
def cox_summary(shop: Shop) -> DataFrame:
    return cox.cox_summary(cox.cox_ph(materialize(shop.design(), "design"))).drop("steps")


@query()
def cox_hazard_ratios(shop: Shop) -> DataFrame:
    """Through the stored CSV report, as the dashboard reads it."""
    path = scratch_path(shop.spark, "cox")
    store.write_report(cox.cox_summary(cox.cox_ph(materialize(shop.design(), "design"))), path)
    return cox.cox_hazard_ratios(store.read_report(shop.spark, path, cox.CHECKED_SCHEMA))


# --- dashboard -----------------------------------------------------------------------------------

def _parts(shop: Shop) -> tuple[jobs.Segmentation, jobs.Churn, jobs.Forecast]:
    """The jobs behind the dashboard, with given centroids and grain, so that SQL can follow the whole chain."""
    tables = jobs.collapsed(shop.tables)
    segmentation = jobs.segment(tables, given=GIVEN, settle=False)
    return segmentation, jobs.churn(tables, segmentation.segments, home_country=HOME), jobs.forecast(tables, "monthly", likelihood=False)


@query()
def dashboard_kpis(shop: Shop) -> DataFrame:
    return jobs.kpis(*_parts(shop))


@query()
def dashboard_document(shop: Shop) -> DataFrame:
    """The whole document as rows: real segment names, Champions as reference of the Cox model."""
    return documents.dashboard_rows(materialize(jobs.dashboard(*_parts(shop)), "dashboard-document"))
