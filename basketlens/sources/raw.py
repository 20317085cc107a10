"""Raw invoice lines: the flat file an analysis starts from."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

RAW_COLUMNS = ["Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price", "Customer ID", "Country"]

# Every column is read as text: the customer id arrives as float text ("13085.0"), which an
# integer schema would turn into NULL without a word.
RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS])

# The texts a CSV reader of the pandas family takes for a missing value.
NULL_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def union_sheets(sheets: Sequence[DataFrame]) -> DataFrame:
    """Stack sheets by column name, keeping duplicates; a column missing from a sheet is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sheets)


def read_raw(spark: SparkSession, path: str | list[str], fmt: str = "csv", null_texts: Sequence[str] = NULL_TEXTS,
             schema: T.StructType | None = None, date_format: str | None = None, **options: str) -> DataFrame:
    """Scan raw lines and type them.

    Quotes inside a field are doubled, as spreadsheet exports write them. Files stay splittable
    unless ``multiLine`` is passed for descriptions that hold line breaks.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("escape", '"')
    if schema is not None:
        reader = reader.schema(schema)
    return type_raw(reader.options(**options).load(path), null_texts, date_format)


def type_raw(lines: DataFrame, null_texts: Sequence[str] = NULL_TEXTS, date_format: str | None = None) -> DataFrame:
    """Strip column names, map null spellings to NULL, cast the typed columns.

    Bad input raises (ANSI casts); it is never turned into NULL.
    """
    lines = lines.toDF(*[name.strip() for name in lines.columns])
    kinds = dict(lines.dtypes)
    as_null = lambda name: (
        F.when(~F.col(name).isin(list(null_texts)), F.col(name)) if kinds[name] == "string" else F.col(name)
    )
    typed = {
        "Quantity": lambda c: c.cast("int"),
        "Price": lambda c: c.cast("decimal(12,4)"),
        "Customer ID": lambda c: c.cast("double").cast("bigint"),
        "InvoiceDate": lambda c: parse_timestamp(c, date_format),
    }
    return lines.select(*[typed.get(name, lambda c: c)(as_null(name)).alias(name) for name in lines.columns])


def parse_timestamp(column, date_format: str | None = None):
    if date_format is None:
        return column.cast("timestamp_ntz")
    return F.to_timestamp_ntz(column.cast("string"), F.lit(date_format))
