import datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from basketlens.operators import audits, cleaning
from basketlens.sources import raw, tables

HEADER = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID ,Country\n"


def read(spark, tmp_path, *lines):
    path = tmp_path / "raw.csv"
    path.write_text(HEADER + "\n".join(lines) + "\n")
    return raw.read_raw(spark, str(path))


def test_csv_types_nulls_and_quotes(spark, tmp_path):
    df = read(spark, tmp_path,
              '1,a,"LAMP ""RED"", big",6,2009-12-01 07:45:00,2.55,13085.0,France',
              "2,b,NA,-1,2009-12-02 00:00:00,0.12345,,NA",
              "3,c,None,2,2009-12-02 00:00:00,1,NA,Spain").orderBy("Invoice")
    assert df.dtypes[3] == ("Quantity", "int") and dict(df.dtypes)["Customer ID"] == "bigint"
    first, second, third = df.collect()
    assert first.Description == 'LAMP "RED", big'
    assert first["Customer ID"] == 13085 and first.InvoiceDate == datetime.datetime(2009, 12, 1, 7, 45)
    assert second.Description is None and second.Country is None and second["Customer ID"] is None
    assert second.Price == Decimal("0.1235")
    assert third.Description is None and third["Customer ID"] is None


def test_bad_date_raises(spark, tmp_path):
    with pytest.raises(PySparkException):
        read(spark, tmp_path, "1,a,x,1,not a date,1,1,France").collect()


def test_union_keeps_duplicates_and_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([("x", 1), ("y", 2)], "s string, n int")
    c = spark.createDataFrame([(3,)], "n int")
    rows = sorted(raw.union_sheets([a, b, c]).collect(), key=str)
    assert [tuple(r) for r in rows] == [(1, "x"), (1, "x"), (2, "y"), (3, None)]


def lines(spark, rows):
    schema = "Invoice string, StockCode string, Description string, Quantity int, InvoiceDate timestamp_ntz, " \
             "Price decimal(12,4), `Customer ID` bigint, Country string"
    day = datetime.datetime(2010, 1, 1)
    full = [(i, s, d, 1, day + datetime.timedelta(days=n), Decimal("1"), c, k)
            for n, (i, s, d, c, k) in enumerate(rows)]
    return spark.createDataFrame(full, schema)


def test_codes_and_cancellations(spark):
    df = cleaning.clean(lines(spark, [
        ("\tC1 ", "a\n", "x", 1, "A"), ("c2", "b", "x", 1, "A"), ("  ", "b", "x", 1, "A"),
        (None, "b", "x", 1, "A"), ("3", None, "x", 1, "A")]))
    rows = {(r.Invoice, r.StockCode, r.is_cancellation) for r in df.collect()}
    assert rows == {("C1", "a", True), ("c2", "b", False), ("", "b", False)}


def test_most_frequent_value(spark):
    df = cleaning.clean(lines(spark, [
        ("1", "p", "blue", 1, "Spain"), ("1", "p", "azure", 1, "France"), ("2", "q", None, 2, None),
        ("3", "p", None, 3, "Spain"), ("4", "p", "blue", 3, "Spain"), ("5", "p", "azure", 3, "France")]))
    assert {tuple(r) for r in cleaning.customers_dim(df).collect()} == {(1, "France"), (2, None), (3, "Spain")}
    assert {tuple(r) for r in cleaning.products_dim(df).collect()} == {("p", "azure"), ("q", None)}


def test_invoice_takes_known_customer_and_first_date(spark):
    df = cleaning.clean(lines(spark, [("9", "p", "x", None, "A"), ("9", "p", "x", 5, "A"), ("C9", "p", "x", 5, "A")]))
    rows = {r.invoice_no: tuple(r)[1:] for r in cleaning.invoices_dim(df).collect()}
    assert rows["9"] == (5, datetime.datetime(2010, 1, 1), False)
    assert rows["C9"] == (5, datetime.datetime(2010, 1, 3), True)


def test_line_total_is_rounded_after_the_price(spark):
    items = spark.createDataFrame([("1", "p", 3, Decimal("0.12345"))],
                                  "invoice_no string, stock_code string, quantity int, unit_price decimal(12,5)")
    row = cleaning.line_totals(items).first()
    assert row.unit_price == Decimal("0.1235") and row.line_total == Decimal("0.3705")


def test_audits_find_violations(spark):
    broken = {
        "customers": spark.createDataFrame([(1, "A"), (1, "B"), (2, None)], tables.SCHEMAS["customers"]),
        "products": spark.createDataFrame([("p", None)], tables.SCHEMAS["products"]),
        "invoices": spark.createDataFrame(
            [("i", 1, datetime.datetime(2020, 1, 1), None), ("j", 7, None, True), ("k", None, None, True)],
            tables.SCHEMAS["invoices"]),
        "invoice_items": spark.createDataFrame(
            [("i", "p", 1, None, None), ("x", "p", None, None, None), ("x", "q", 1, None, None)],
            tables.SCHEMAS["invoice_items"]),
    }
    keys = {r.table_name: r.violations for r in audits.audit_primary_keys(broken).collect()}
    assert keys == {"customers": 1, "products": 0, "invoices": 0}
    foreign = {(r.child_table, r.key_column): (r.orphan_keys, r.orphan_rows)
               for r in audits.audit_foreign_keys(broken).collect()}
    assert foreign == {("invoices", "customer_id"): (1, 1), ("invoice_items", "invoice_no"): (1, 2),
                       ("invoice_items", "stock_code"): (1, 1)}
    nulls = {(r.table_name, r.column_name): r.null_rows for r in audits.audit_not_null(broken).collect()}
    assert nulls[("customers", "country")] == 1 and nulls[("invoices", "invoice_date")] == 2
    assert nulls[("invoice_items", "quantity")] == 1 and nulls[("invoice_items", "unit_price")] == 3
    assert audits.default_flag(broken["invoices"]).filter("is_cancellation is null").count() == 0



def test_reports_and_documents_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a, \"b\"", 1.5)], "name string, x double")
    tables.write_report(df, str(tmp_path / "r"))
    assert tables.read_report(spark, str(tmp_path / "r"), df.schema).collect() == df.collect()
    odd = spark.createDataFrame([(float("inf"),), (float("nan"),), (2.0,)], "x double")
    assert [r.x for r in odd.select(tables.finite(F.col("x")).alias("x")).collect()] == [None, None, 2.0]
