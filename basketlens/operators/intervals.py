"""Gaps between consecutive purchases, and the churn threshold drawn from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from basketlens.functions.scalars import calendar_days, round_half_even


def purchase_intervals(invoices: DataFrame) -> DataFrame:
    """Calendar days since the customer's previous purchase, for every purchase but the first.

    Cancellations and guests do not count. Gaps are counted in days, so only the first purchase of
    a customer's day looks back to an earlier day; the others follow a purchase of the same day.
    The look-back window then holds at most one row per customer and day, and no window ever sorts
    all the invoices of one customer.
    """
    purchases = (
        invoices.filter(F.col("customer_id").isNotNull() & ~F.col("is_cancellation"))
        .select("customer_id", "invoice_no", "invoice_date", F.to_date("invoice_date").alias("_day"))
        .repartition("customer_id", "_day")  # serves the distinct and the first window
        .distinct()
    )
    in_day = W.partitionBy("customer_id", "_day").orderBy("invoice_date", "invoice_no")
    days = W.partitionBy("customer_id", "_later").orderBy("_day")
    return (
        purchases.withColumn("_nth", F.row_number().over(in_day))
        .withColumn("_later", F.when(F.col("_nth") > 1, F.col("_day")))
        .withColumn("_previous", F.when(F.col("_nth") > 1, F.col("_day")).otherwise(F.lag("_day").over(days)))
        .filter(F.col("_previous").isNotNull())
        .select(
            "customer_id", "invoice_no", "invoice_date",
            calendar_days(F.col("_day"), F.col("_previous")).alias("days_since_prev_purchase"),
        )
    )


def churn_threshold(intervals: DataFrame, quantile: float = 0.9) -> DataFrame:
    """The exact interpolated quantile of the gaps, rounded half-even to whole days.

    The aggregate keeps one counter per distinct gap: bounded by the days of history.
    """
    gap = F.percentile("days_since_prev_purchase", quantile)
    return intervals.agg(
        gap.alias("gap_quantile"),
        round_half_even(gap).cast("int").alias("churn_threshold_days"),
    )
