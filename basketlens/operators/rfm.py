"""Invoice revenue and the recency / frequency / monetary frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from basketlens.functions.scalars import calendar_days, next_day_after
from basketlens.operators.ranking import global_rank, ntile_of, ranked_median
from basketlens.session import materialize


def invoice_totals(items: DataFrame, *keys: str) -> DataFrame:
    """Sum of the lines per invoice (and per further line key).

    Summed before any join: the map side collapses an invoice that holds a large share of all lines,
    the join sees one row per invoice, and its shuffle on ``invoice_no`` is the one already made here.
    """
    return items.groupBy("invoice_no", *keys).agg(F.sum("line_total").alias("invoice_net_revenue"))


def collapse_lines(items: DataFrame) -> DataFrame:
    """One stored row per invoice, which the revenue operators take in place of the lines.

    Features, lifecycles and sales series all start from invoice sums: a run of several of them
    scans the lines once.
    """
    return materialize(items.groupBy("invoice_no").agg(F.sum("line_total").alias("line_total")), "invoice-totals")


def invoice_revenue(invoices: DataFrame, items: DataFrame) -> DataFrame:
    """Net revenue of every invoice that has a customer and at least one line."""
    return (
        invoices.filter(F.col("customer_id").isNotNull())
        .join(invoice_totals(items), "invoice_no")
        .select("customer_id", "invoice_no", "invoice_date", "is_cancellation", "invoice_net_revenue")
    )


def snapshot_date(invoices: DataFrame) -> DataFrame:
    """The day after the last invoice of any kind, cancellations and guests included."""
    return invoices.agg(next_day_after(F.max("invoice_date")).alias("snapshot_date"))


def customer_rfm(invoices: DataFrame, items: DataFrame) -> DataFrame:
    """Last purchase, purchase count and net spend per customer.

    Cancellations are netted in the money and ignored by the other two. Invoices are unique here,
    so the distinct count is a plain count. Customers with cancellations only are dropped.
    """
    purchase = ~F.col("is_cancellation")
    return (
        invoice_revenue(invoices, items)
        .groupBy("customer_id")
        .agg(
            F.max(F.when(purchase, F.col("invoice_date"))).alias("last_purchase_date"),
            F.count_if(purchase).alias("frequency"),
            F.sum("invoice_net_revenue").alias("net_revenue"),
        )
        .filter("frequency > 0")
    )


def rfm_features(invoices: DataFrame, items: DataFrame, tiles: int = 5) -> DataFrame:
    """Recency, frequency, monetary value and the spend n-tile used as a naive baseline.

    Ties in spend are broken by customer id. The customer frame is stored once, because ranking
    reads it several times and must not repeat the scan of the lines.
    """
    return features_of(customer_rfm(invoices, items), invoices, tiles)


def features_of(customers: DataFrame, invoices: DataFrame, tiles: int = 5) -> DataFrame:
    """``rfm_features`` from one row per customer; of the invoices only the last date is read."""
    snapshot = snapshot_date(invoices).scalar()
    ranked = global_rank(materialize(customers, "customer-rfm"), "net_revenue", "customer_id")
    return ranked.select(
        "customer_id",
        calendar_days(snapshot, F.col("last_purchase_date")).alias("recency_days"),
        "frequency",
        F.round("net_revenue", 2).alias("monetary"),
        ntile_of(F.col("rank"), F.col("total"), tiles).alias("naive_monetary_quintile"),
    )


def rfm_medians(rfm: DataFrame) -> DataFrame:
    """One row with the medians of the three features.

    Days and order counts have few distinct values, so the exact aggregate stays small for them;
    spend does not, so its median comes from the global rank. Pass a stored frame.
    """
    narrow = rfm.agg(F.median("recency_days").alias("recency_days"), F.median("frequency").alias("frequency"))
    monetary: Column = ranked_median(global_rank(rfm.select("monetary", "customer_id"), "monetary", "customer_id"),
                                     "monetary").scalar()
    return narrow.withColumn("monetary", monetary)
