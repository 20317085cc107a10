"""Net sales per period."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from basketlens.operators.rfm import invoice_totals


def monthly_sales(invoices: DataFrame, items: DataFrame) -> DataFrame:
    """Net sales and invoices per month; guests count, cancellations net out."""
    return (
        invoices.select("invoice_no", "invoice_date")
        .join(invoice_totals(items), "invoice_no")
        .groupBy(F.trunc("invoice_date", "month").alias("period"))
        .agg(F.sum("invoice_net_revenue").alias("net_sales"), F.count("*").alias("invoice_count"))
    )


def daily_sales(invoices: DataFrame, items: DataFrame) -> DataFrame:
    """Net sales per day with sales; guests count, cancellations net out."""
    return (
        invoices.select("invoice_no", "invoice_date")
        .join(invoice_totals(items), "invoice_no")
        .groupBy(F.to_date("invoice_date").alias("day"))
        .agg(F.sum("invoice_net_revenue").alias("net_sales"))
    )


def daily_sales_by(invoices: DataFrame, items: DataFrame, key: str, lookup: DataFrame | None = None,
                   on: str | None = None) -> DataFrame:
    """Daily net sales of one series per value of ``key``: ``(series_id, day, net_sales)``.

    ``key`` is a column of the invoices, of the lines, or of a ``lookup`` table joined on ``on``
    after the lines have been summed.
    """
    line_keys = [key] if lookup is None and key in items.columns and key != "invoice_no" else []
    wanted = [c for c in (on, key) if c in invoices.columns]
    sales = invoices.select("invoice_no", "invoice_date", *wanted).join(invoice_totals(items, *line_keys), "invoice_no")
    day = F.to_date("invoice_date").alias("day")
    if lookup is None:
        return sales.groupBy(F.col(key).cast("string").alias("series_id"), day).agg(
            F.sum("invoice_net_revenue").alias("net_sales"))
    # Collapse to (lookup key, day) before the join: a hot key is a handful of rows by then.
    per_key = sales.groupBy(on, day).agg(F.sum("invoice_net_revenue").alias("net_sales"))
    return (
        per_key.join(lookup.select(on, key), on)
        .groupBy(F.col(key).cast("string").alias("series_id"), "day")
        .agg(F.sum("net_sales").alias("net_sales"))
    )
