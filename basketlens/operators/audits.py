"""The table constraints as queries: Spark does not enforce keys. One row per constraint."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F

# Keys, references and required columns of the four tables.
PRIMARY_KEYS = {"customers": "customer_id", "products": "stock_code", "invoices": "invoice_no"}
FOREIGN_KEYS = [
    ("invoices", "customer_id", "customers"),
    ("invoice_items", "invoice_no", "invoices"),
    ("invoice_items", "stock_code", "products"),
]
REQUIRED = {
    "customers": ["country"],
    "invoices": ["invoice_date", "is_cancellation"],
    "invoice_items": ["invoice_no", "stock_code", "quantity", "unit_price"],
}


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def audit_primary_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Keys that are NULL or occur more than once."""
    def check(name: str, key: str) -> DataFrame:
        sizes = tables[name].groupBy(key).agg(F.count("*").alias("n"))
        return sizes.agg(
            F.lit(name).alias("table_name"), F.lit(key).alias("key_column"),
            F.count("*").alias("keys"),
            F.count_if((F.col("n") > 1) | F.col(key).isNull()).alias("violations"),
        )
    return _stack([check(name, key) for name, key in PRIMARY_KEYS.items()])


def audit_foreign_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Keys, and the rows that carry them, without a parent row. A NULL key is allowed.

    References are counted per key before the join, so a popular key crosses the network as one row.
    """
    def check(child: str, key: str, parent: str) -> DataFrame:
        used = tables[child].filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
        orphans = used.join(tables[parent].select(key), key, "left_anti")
        return orphans.agg(
            F.lit(child).alias("child_table"), F.lit(key).alias("key_column"), F.lit(parent).alias("parent_table"),
            F.count("*").alias("orphan_keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"),
        )
    return _stack([check(*edge) for edge in FOREIGN_KEYS])


def audit_not_null(tables: Mapping[str, DataFrame]) -> DataFrame:
    """NULLs in required columns, counted in one pass per table."""
    def check(name: str, columns: list[str]) -> DataFrame:
        counts = tables[name].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        return counts.unpivot([], columns, "column_name", "null_rows").select(
            F.lit(name).alias("table_name"), "column_name", "null_rows")
    return _stack([check(name, columns) for name, columns in REQUIRED.items()])


def default_flag(invoices: DataFrame) -> DataFrame:
    """A missing cancellation flag means no cancellation."""
    return invoices.withColumn("is_cancellation", F.coalesce("is_cancellation", F.lit(False)))
