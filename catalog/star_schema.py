"""Retail tables derived from an orders / lineitem star schema.

The star schema holds no cancellation, guest or dirty value, so arithmetic on its keys makes them:
orders divisible by 17 are cancellations, orders with remainder 3 modulo 11 have no customer, the
hour of day is the order key modulo 24, and raw lines get missing codes, padded codes, variant
descriptions and inconsistent countries. The same statements serve Spark and the SQL counterparts;
names in braces are the base tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

# Given, so that opening a table costs no job to infer them.
BASE = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
}

INVOICES = """
select concat(case when o_orderkey % 17 = 0 then 'C' else '' end, cast(o_orderkey as string)) as invoice_no,
       case when o_orderkey % 11 = 3 then null else o_custkey end as customer_id,
       o_orderdate + interval '1' hour * (o_orderkey % 24) as invoice_date,
       o_orderkey % 17 = 0 as is_cancellation
from {orders}
"""

INVOICE_ITEMS = """
select concat(case when l_orderkey % 17 = 0 then 'C' else '' end, cast(l_orderkey as string)) as invoice_no,
       cast(l_partkey as string) as stock_code,
       cast(case when l_orderkey % 17 = 0 then -l_quantity else l_quantity end as int) as quantity,
       cast(p_retailprice as decimal(12,4)) as unit_price,
       cast(cast(case when l_orderkey % 17 = 0 then -l_quantity else l_quantity end as int)
            * cast(p_retailprice as decimal(12,4)) as decimal(14,4)) as line_total
from {lineitem} join {part} on p_partkey = l_partkey
"""

CUSTOMERS = """
select distinct c_custkey as customer_id, n_name as country
from {orders} join {customer} on c_custkey = o_custkey join {nation} on n_nationkey = c_nationkey
where o_orderkey % 11 <> 3
"""

PRODUCTS = "select cast(p_partkey as string) as stock_code, p_name as description from {part}"

RAW_LINES = """
select case when (l_orderkey * 7 + l_linenumber) % 997 = 0 then null
            else concat(case when l_linenumber = 2 then ' ' else '' end,
                        case when l_orderkey % 17 = 0 then 'C' else '' end, cast(l_orderkey as string)) end as Invoice,
       case when (l_orderkey * 5 + l_linenumber) % 991 = 0 then null
            else concat(cast(l_partkey as string), case when l_linenumber = 3 then ' ' else '' end) end as StockCode,
       case when l_linenumber = 6 then null
            when l_linenumber = 5 then concat(p_name, ' (damaged)') else p_name end as Description,
       cast(case when l_orderkey % 17 = 0 then -l_quantity else l_quantity end as int) as Quantity,
       o_orderdate + interval '1' hour * (o_orderkey % 24) as InvoiceDate,
       cast(p_retailprice as decimal(12,4)) as Price,
       case when l_orderkey % 11 = 3 then null else concat(cast(o_custkey as string), '.0') end as CustomerID,
       case when l_linenumber = 7 then sn.n_name else cn.n_name end as Country
from {lineitem} join {orders} on o_orderkey = l_orderkey join {part} on p_partkey = l_partkey
join {customer} on c_custkey = o_custkey join {nation} cn on cn.n_nationkey = c_nationkey
join {supplier} on s_suppkey = l_suppkey join {nation} sn on sn.n_nationkey = s_nationkey
"""

STATEMENTS = {
    "invoices": INVOICES,
    "invoice_items": INVOICE_ITEMS,
    "customers": CUSTOMERS,
    "products": PRODUCTS,
    "raw_lines": RAW_LINES,
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One retail table over the star schema in ``sf_dir``."""
    statement = STATEMENTS[name]
    tables = {
        base: spark.read.schema(schema).parquet(f"{sf_dir}/{base}.parquet")
        for base, schema in BASE.items() if "{" + base + "}" in statement
    }
    return spark.sql(statement, **tables)


def sql_for(name: str) -> str:
    """The same table as SQL text over views named like the base tables."""
    return reduce(lambda text, base: text.replace("{" + base + "}", base), BASE, STATEMENTS[name]).strip()
