"""From raw invoice lines to four normalised tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from basketlens.functions.scalars import strip_text
from basketlens.sources.raw import parse_timestamp

CANCELLATION_PREFIX = "C"


def drop_missing_keys(raw: DataFrame) -> DataFrame:
    """Drop lines without an invoice or a stock code. A blank code is not a missing one."""
    return raw.dropna(subset=["Invoice", "StockCode"])


def trim_codes(raw: DataFrame) -> DataFrame:
    return raw.withColumns({name: strip_text(F.col(name)) for name in ("Invoice", "StockCode")})


def parse_dates(raw: DataFrame, date_format: str | None = None) -> DataFrame:
    """Text to timestamp; raises on text that is no date."""
    return raw.withColumn("InvoiceDate", parse_timestamp(F.col("InvoiceDate"), date_format))


def flag_cancellations(raw: DataFrame) -> DataFrame:
    """Flag, never drop: whether to net or exclude cancellations is left to each analysis."""
    return raw.withColumn("is_cancellation", F.col("Invoice").startswith(CANCELLATION_PREFIX))


def clean(raw: DataFrame) -> DataFrame:
    return flag_cancellations(parse_dates(trim_codes(drop_missing_keys(raw))))


def value_counts(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value, n): how often each key has each value, NULL included. Counts of two halves add up to those of both."""
    return df.groupBy(key, value).agg(F.count("*").alias("n"))


def most_frequent_of(counts: DataFrame, key: str, value: str) -> DataFrame:
    """Most frequent non-null value per key, the smallest one on a tie; NULL if there is none."""
    best = F.min(F.when(F.col(value).isNotNull(), F.struct((-F.col("n")).alias("rank"), F.col(value).alias("value"))))
    return counts.groupBy(key).agg(best.alias("_best")).select(key, F.col("_best.value").alias(value))


def most_frequent(df: DataFrame, key: str, value: str) -> DataFrame:
    """``most_frequent_of`` the rows themselves.

    Counted per (key, value) first, so a key that owns a large share of the rows is collapsed on
    the map side and no task ever holds all the values of a key.
    """
    return most_frequent_of(value_counts(df, key, value), key, value)


def customer_countries(cleaned: DataFrame) -> DataFrame:
    """Lines per known customer and country."""
    known = cleaned.filter(F.col("Customer ID").isNotNull())
    return value_counts(known, "Customer ID", "Country").toDF("customer_id", "country", "n")


def product_descriptions(cleaned: DataFrame) -> DataFrame:
    """Lines per stock code and description."""
    return value_counts(cleaned, "StockCode", "Description").toDF("stock_code", "description", "n")


def customers_dim(cleaned: DataFrame) -> DataFrame:
    """One row per known customer with the most frequent country."""
    return most_frequent_of(customer_countries(cleaned), "customer_id", "country")


def products_dim(cleaned: DataFrame) -> DataFrame:
    """One row per stock code with the most frequent description."""
    return most_frequent_of(product_descriptions(cleaned), "stock_code", "description")


def invoices_dim(cleaned: DataFrame) -> DataFrame:
    """One row per invoice. The customer is the smallest non-null id on it: rows have no order here,
    and an invoice names one customer."""
    return cleaned.groupBy(F.col("Invoice").alias("invoice_no")).agg(
        F.min("Customer ID").alias("customer_id"),
        F.min("InvoiceDate").alias("invoice_date"),
        F.bool_or("is_cancellation").alias("is_cancellation"),
    )


def invoice_items_fact(cleaned: DataFrame) -> DataFrame:
    """Every line as it is: no de-duplication, no filter on quantity or price."""
    return cleaned.select(
        F.col("Invoice").alias("invoice_no"),
        F.col("StockCode").alias("stock_code"),
        F.col("Quantity").alias("quantity"),
        F.col("Price").alias("unit_price"),
    )


def line_totals(items: DataFrame) -> DataFrame:
    """Add quantity x unit price; the price is rounded to four places first, as it is stored."""
    price = F.col("unit_price").cast("decimal(12,4)")
    return items.withColumn("unit_price", price).withColumn(
        "line_total", (F.col("quantity") * F.col("unit_price")).cast("decimal(14,4)"))


def tables_from(cleaned: DataFrame) -> dict[str, DataFrame]:
    """The four tables. Each reads a few columns of the cleaned lines: store those as Parquet first."""
    return {
        "customers": customers_dim(cleaned),
        "products": products_dim(cleaned),
        "invoices": invoices_dim(cleaned),
        "invoice_items": line_totals(invoice_items_fact(cleaned)),
    }


def guest_lines(invoices: DataFrame, items: DataFrame) -> DataFrame:
    """Lines per kind of buyer: guest lines stay in the facts, customer tables leave them out."""
    lines = items.groupBy("invoice_no").agg(F.count("*").alias("lines"), F.sum("line_total").alias("net_sales"))
    return (
        invoices.select("invoice_no", F.col("customer_id").isNull().alias("is_guest"))
        .join(lines, "invoice_no")
        .groupBy("is_guest")
        .agg(F.count("*").alias("invoices"), F.sum("lines").alias("lines"), F.sum("net_sales").alias("net_sales"))
    )


def load_counts(raw: DataFrame) -> DataFrame:
    """Rows before and after cleaning and rows of each table: ``(stage, row_count)``.

    Reads ``raw`` four times, a few columns each: pass a stored frame.
    """
    cleaned = clean(raw)
    kept = F.col("Invoice").isNotNull() & F.col("StockCode").isNotNull()
    lines = raw.agg(
        F.count("*").alias("raw"),
        F.count_if(kept).alias("clean"),
        F.count_if(~kept).alias("dropped"),
        F.count_if(kept).alias("invoice_items"),
    ).unpivot([], ["raw", "clean", "dropped", "invoice_items"], "stage", "row_count")
    keys = {
        "customers": cleaned.select("Customer ID").dropna(),
        "products": cleaned.select("StockCode"),
        "invoices": cleaned.select("Invoice"),
    }
    counts = [df.distinct().agg(F.lit(stage).alias("stage"), F.count("*").alias("row_count"))
              for stage, df in keys.items()]
    for count in counts:
        lines = lines.unionByName(count)
    return lines
