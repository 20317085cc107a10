"""What a customer has done so far, in a form that merges: the activity of two sets of invoices adds up to that of both.

Features and lifecycles start from one row per customer. That row is a sum, a count, a first and a last date, so a
load that is appended to brings its own rows and none of the lines before it is read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from basketlens.operators.rfm import invoice_revenue

SCHEMA = ("customer_id bigint, first_purchase_date timestamp_ntz, last_purchase_date timestamp_ntz, purchases bigint, "
          "gross_revenue decimal(38,4), net_revenue decimal(38,4)")


def _typed(activity: DataFrame) -> DataFrame:
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    money = lambda c: F.col(c).cast("decimal(38,4)").alias(c) if c.endswith("revenue") else F.col(c)
    return activity.select(*[money(c) for c in names])


def customer_activity(invoices: DataFrame, items: DataFrame) -> DataFrame:
    """One row per customer with lines: purchases are invoices that are no cancellations; net revenue counts both."""
    purchase = ~F.col("is_cancellation")
    return _typed(invoice_revenue(invoices, items).groupBy("customer_id").agg(
        F.min(F.when(purchase, F.col("invoice_date"))).alias("first_purchase_date"),
        F.max(F.when(purchase, F.col("invoice_date"))).alias("last_purchase_date"),
        F.count_if(purchase).alias("purchases"),
        F.coalesce(F.sum(F.when(purchase, F.col("invoice_net_revenue"))), F.lit(0)).alias("gross_revenue"),
        F.sum("invoice_net_revenue").alias("net_revenue")))


def merge_activity(activity: DataFrame) -> DataFrame:
    """Rows of several disjoint sets of invoices, stacked, become one row per customer."""
    return _typed(activity.groupBy("customer_id").agg(
        F.min("first_purchase_date").alias("first_purchase_date"), F.max("last_purchase_date").alias("last_purchase_date"),
        *[F.sum(c).alias(c) for c in ("purchases", "gross_revenue", "net_revenue")]))


def rfm_of(activity: DataFrame) -> DataFrame:
    """The frame that features are made of: see ``rfm.customer_rfm``."""
    return activity.filter("purchases > 0").select(
        "customer_id", "last_purchase_date", F.col("purchases").alias("frequency"), "net_revenue")


def lifecycle_of(activity: DataFrame) -> DataFrame:
    """First and last purchase, count and gross spend: see ``survival.lifecycle_aggregates``."""
    return activity.filter("purchases > 0").select(
        "customer_id", "first_purchase_date", "last_purchase_date", F.col("purchases").alias("frequency"),
        F.col("gross_revenue").alias("monetary"))
