"""Customer lifecycles, the survival frame, Kaplan-Meier curves and the log-rank test.

Durations are whole days, so everything after the first aggregation has at most one row per group
and day of history; the windows below run over those rows, never over customers.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from basketlens.functions.scalars import elapsed_days, next_day_after, signed_log
from basketlens.functions.special import Z_95, chi2_tail
from basketlens.operators.rfm import invoice_totals
from basketlens.session import ship_package

HOME_COUNTRY = "United Kingdom"
GROUP = "segment_label"


def lifecycle_aggregates(invoices: DataFrame, items: DataFrame) -> DataFrame:
    """First and last purchase, purchase count and gross spend per customer; cancellations are left out."""
    purchases = invoices.filter(F.col("customer_id").isNotNull() & ~F.col("is_cancellation"))
    return (
        purchases.select("customer_id", "invoice_no", "invoice_date")
        .join(invoice_totals(items), "invoice_no")
        .groupBy("customer_id")
        .agg(
            F.min("invoice_date").alias("first_purchase_date"),
            F.max("invoice_date").alias("last_purchase_date"),
            F.count("*").alias("frequency"),
            F.sum("invoice_net_revenue").alias("monetary"),
        )
    )


def customer_lifecycle(invoices: DataFrame, items: DataFrame, customers: DataFrame) -> DataFrame:
    """The lifecycle with the customer's country, joined when there is one row per customer left.

    ``customer_id`` is the audited key of ``customers``.
    """
    return lifecycle_aggregates(invoices, items).join(customers.select("customer_id", "country"), "customer_id")


def survival_frame(lifecycle: DataFrame, segments: DataFrame, threshold_days: int,
                   home_country: str = HOME_COUNTRY) -> DataFrame:
    """Churn event, duration and covariates per customer.

    Churned means more than ``threshold_days`` whole days without a purchase before the snapshot,
    the day after the last purchase in ``lifecycle``; the duration then ends at the last purchase,
    otherwise at the snapshot. ``lifecycle`` is read twice: pass a stored frame.
    """
    newest = lifecycle.agg(next_day_after(F.max("last_purchase_date")).cast("string")).first()[0]
    snapshot = F.lit(newest).cast("timestamp_ntz")
    churned = elapsed_days(snapshot, F.col("last_purchase_date")) > threshold_days
    until = F.when(churned, F.col("last_purchase_date")).otherwise(snapshot)
    order_value = F.col("monetary").cast("double") / F.col("frequency")
    return lifecycle.join(segments.select("customer_id", GROUP), "customer_id").select(
        "customer_id", "first_purchase_date", "last_purchase_date", "frequency",
        F.col("monetary").cast("double").alias("monetary"), "country",
        churned.cast("int").alias("event"),
        elapsed_days(until, F.col("first_purchase_date")).alias("duration"),
        GROUP,
        F.log1p(F.col("frequency").cast("double")).alias("log_frequency"),
        signed_log(order_value).alias("avg_order_value_signed_log"),
        (F.col("country") == home_country).cast("int").alias("is_uk"),
    )


def churn_overview(survival: DataFrame) -> DataFrame:
    return survival.agg(
        F.count("*").alias("customers"),
        F.sum("event").alias("events"),
        (F.sum("event") / F.count("*")).alias("event_rate"),
        (F.count("*") - F.sum("event")).alias("censored"),
    )


def event_table(survival: DataFrame, group: str = GROUP) -> DataFrame:
    """Deaths and exits per group and duration."""
    return survival.groupBy(group, "duration").agg(F.sum("event").alias("deaths"), F.count("*").alias("exits"))


def km_curves(survival: DataFrame, group: str = GROUP) -> DataFrame:
    """Product-limit survival per group at every distinct duration.

    A curve without an exit on day 0 starts with a row for it. ``greenwood`` is the running sum of
    d / (n (n - d)); it is NULL once the whole risk set has died.
    """
    by_group = W.partitionBy(group)
    forward = by_group.orderBy("duration").rowsBetween(W.unboundedPreceding, W.currentRow)
    # Counted down from the longest duration: a frame that runs to the end would be summed anew per row.
    onward = by_group.orderBy(F.col("duration").desc()).rowsBetween(W.unboundedPreceding, W.currentRow)
    own = F.struct("duration", "deaths", "exits")
    zero = F.struct(*[F.lit(0).cast(t).alias(c) for c, t in
                      [("duration", "int"), ("deaths", "bigint"), ("exits", "bigint")]])
    first = (F.col("duration") > 0) & (F.col("duration") == F.min("duration").over(by_group))
    rows = event_table(survival, group).withColumn("_first", first).select(
        group, F.inline(F.when(F.col("_first"), F.array(zero, own)).otherwise(F.array(own))))
    dead_out = F.max((F.col("deaths") == F.col("at_risk")).cast("int")).over(forward) == 1
    share = F.col("deaths") / (F.col("at_risk") * F.nullif(F.col("at_risk") - F.col("deaths"), F.lit(0)))
    return (
        rows.withColumn("at_risk", F.sum("exits").over(onward))
        .withColumn("survival", F.product(1 - F.col("deaths") / F.col("at_risk")).over(forward))
        .withColumn("greenwood", F.when(~dead_out, F.sum(share).over(forward)))
        .select(group, "duration", "deaths", "exits", "at_risk", "survival", "greenwood")
    )


def km_confidence(curves: DataFrame) -> DataFrame:
    """95 % bounds of each curve point, Greenwood variance on the log-log scale.

    Both are 1 while nobody has died, NULL when nobody is left.
    """
    s = F.col("survival")
    inside = (s > 0) & (s < 1) & F.col("greenwood").isNotNull()
    error = F.when(inside, F.sqrt("greenwood") / F.abs(F.ln(s)))
    bound = lambda sign: F.when(s == 1, 1.0).when(inside, F.pow(s, F.exp(F.lit(sign * Z_95) * error)))
    return curves.withColumns({"lower": bound(1), "upper": bound(-1)})


def km_median(curves: DataFrame, group: str = GROUP) -> DataFrame:
    """Shortest duration with survival at or below one half; NULL when it is never reached."""
    return curves.groupBy(group).agg(F.min(F.when(F.col("survival") <= 0.5, F.col("duration"))).alias("median_days"))


def km_document(curves: DataFrame, group: str = GROUP) -> DataFrame:
    """One row per group: size, days, and survival to four places."""
    points = F.sort_array(F.collect_list(F.struct("duration", F.bround("survival", 4).alias("survival"))))
    return curves.groupBy(group).agg(
        F.sum("exits").alias("n"),
        F.transform(points, lambda p: p.duration).alias("days"),
        F.transform(points, lambda p: p.survival).alias("survival"),
    )


def logrank(survival: DataFrame, group: str = GROUP) -> DataFrame:
    """Observed and expected deaths and the covariance of their difference, per group.

    ``covariance`` lists the row's covariances in ascending order of the group names. The table is long, one
    row per group and day with a death, so any number of groups will do. Work and output are groups x groups
    x days at most: a statistic over groups, whose count does not grow with the customers.
    """
    events = event_table(survival, group)
    days = events.groupBy("duration").agg(F.sum("deaths").alias("d"), F.sum("exits").alias("x"))
    # One row per day of history, and per group and day, counted down from the longest duration.
    onward = W.orderBy(F.col("duration").desc()).rowsBetween(W.unboundedPreceding, W.currentRow)
    own = W.partitionBy(group).orderBy(F.col("duration").desc()).rowsBetween(W.unboundedPreceding, W.currentRow)
    deadly = days.withColumn("n", F.sum("x").over(onward)).where("d > 0").select("duration", "d", "n")
    # Deaths and exits of each group as steps; a group's risk set on a day is carried from its next later exit.
    names = events.agg(F.collect_set(group)).scalar()
    grid = deadly.select("duration", F.explode(names).alias(group))  # groups x days
    held = (grid.join(events, [group, "duration"], "full")
            .select(group, "duration", F.coalesce("deaths", F.lit(0)).alias("dead"), F.coalesce("exits", F.lit(0)).alias("gone"))
            .withColumn("at_risk", F.sum("gone").over(own)))
    risk = held.join(deadly, "duration").withColumns({
        "share": F.col("at_risk") / F.col("n"),
        "spread": F.when(F.col("n") > 1, F.col("d") * (F.col("n") - F.col("d")) / (F.col("n") - 1)).otherwise(0.0)})
    totals = risk.groupBy(group).agg(F.sum("dead").alias("observed"), F.sum(F.col("d") * F.col("share")).alias("expected"),
                                     F.sum(F.col("spread") * F.col("share")).alias("own"))
    other = risk.where("at_risk > 0").select("duration", F.col(group).alias("other"), F.col("share").alias("other_share"))
    crossed = (risk.where("at_risk > 0").join(other, "duration").groupBy(group, "other")
               .agg(F.sum(F.col("spread") * F.col("share") * F.col("other_share")).alias("crossed")))
    pairs = totals.select("*", F.explode(names).alias("other")).join(crossed, [group, "other"], "left")
    cell = F.when(F.col(group) == F.col("other"), F.col("own")).otherwise(0.0) - F.coalesce("crossed", F.lit(0.0))
    ordered = F.sort_array(F.collect_list(F.struct("other", cell.alias("v"))))
    return pairs.groupBy(group, "observed", "expected").agg(F.transform(ordered, lambda c: c["v"]).alias("covariance"))


@F.pandas_udf(T.StructType([T.StructField("statistic", T.DoubleType()), T.StructField("degrees", T.IntegerType()),
                            T.StructField("p_value", T.DoubleType())]))
def _logrank_statistic(difference: pd.Series, covariance: pd.Series) -> pd.DataFrame:
    def one(z, v):
        z, v = np.asarray(z, float)[:-1], np.vstack(v).astype(float)[:-1, :-1]
        if not len(z):
            return 0.0, 0, 1.0  # a single group differs from nothing
        x = float(z @ np.linalg.pinv(v) @ z)
        return x, len(z), chi2_tail(x, len(z))
    return pd.DataFrame([one(z, v) for z, v in zip(difference, covariance)],
                        columns=["statistic", "degrees", "p_value"])


def logrank_test(table: DataFrame, group: str = GROUP, level: float = 0.05) -> DataFrame:
    """Chi-square statistic over all groups but one, its p-value and the verdict, from ``logrank``."""
    ship_package(table.sparkSession)
    ordered = F.sort_array(F.collect_list(F.struct(
        F.col(group).alias("name"), (F.col("observed") - F.col("expected")).alias("z"), "covariance")))
    return (
        table.agg(ordered.alias("rows"))
        .select(_logrank_statistic(F.col("rows.z"), F.col("rows.covariance")).alias("test"))
        .select("test.*", (F.col("test.p_value") < level).alias("differs"))
    )
