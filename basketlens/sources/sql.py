"""The analysis in SQL text: tables and operators as views, parameterised operators as table functions.

``register`` names them in the session. A view is the operator's own plan, so that a query over it is optimised as a
whole: filters and columns reach the scans. Table functions are SQL text over these views; where an operator has a
parameter, that is the function's.
"""

from __future__ import annotations

from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from basketlens.operators import intervals, rfm, sales, survival

#: Table functions: parameters, columns, and the statement over the views.
FUNCTIONS = {
    "churn_threshold": (
        "quantile double default 0.9", "gap_quantile double, churn_threshold_days int",
        "select q, cast(bround(q, 0) as int) from (select low + (place - floor(place)) * (high - low) as q from ("
        "select any_value(place) as place, min(gap) filter (where upto > floor(place)) as low, "
        "min(gap) filter (where upto > ceil(place)) as high from ("
        "select gap, sum(n) over (order by gap) as upto, churn_threshold.quantile * (sum(n) over () - 1) as place "
        "from (select days_since_prev_purchase as gap, count(*) as n from purchase_intervals group by 1))))"),
    "sales_between": (
        "first_month date, last_month date", "sales_month date, net_sales decimal(38,4)",
        "select period, cast(net_sales as decimal(38,4)) from monthly_sales "
        "where period between trunc(sales_between.first_month, 'month') and sales_between.last_month"),
    "customers_of": (
        "in_country string", "customer_id bigint, recency_days int, frequency bigint, monetary decimal(38,2)",
        "select f.customer_id, recency_days, frequency, cast(monetary as decimal(38,2)) from rfm_features f join customers c "
        "on c.customer_id = f.customer_id where c.country = customers_of.in_country"),
    "purchases_of": (
        "customer bigint", "invoice_no string, invoice_date timestamp_ntz, days_since_prev_purchase int",
        "select invoice_no, invoice_date, days_since_prev_purchase from purchase_intervals where customer_id = purchases_of.customer"),
}


def views(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Operators that become views beside the tables themselves."""
    invoices, items, customers = (tables[n] for n in ("invoices", "invoice_items", "customers"))
    return {
        **tables,
        "invoice_revenue": rfm.invoice_revenue(invoices, items),
        "rfm_features": rfm.rfm_features(invoices, items),
        "purchase_intervals": intervals.purchase_intervals(invoices),
        "monthly_sales": sales.monthly_sales(invoices, items),
        "daily_sales": sales.daily_sales(invoices, items),
        "customer_lifecycle": survival.customer_lifecycle(invoices, items, customers),
    }


def register(spark: SparkSession, tables: Mapping[str, DataFrame]) -> None:
    """Name the views and table functions in this session; those named before are replaced."""
    for name, df in views(tables).items():
        df.createOrReplaceTempView(name)
    for name, (parameters, columns, statement) in FUNCTIONS.items():
        spark.sql(f"create or replace temporary function {name}({parameters}) returns table({columns}) return {statement}")


def run_file(spark: SparkSession, path: str) -> DataFrame:
    """The result of the last statement of a file; statements end with a semicolon at the end of a line."""
    statements = [s.strip().removesuffix(";") for s in Path(path).read_text().split(";\n") if s.strip().strip(";")]
    if not statements:
        raise ValueError(f"{path} holds no statement")
    return [spark.sql(s) for s in statements][-1]
