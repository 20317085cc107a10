"""Operators as views and table functions in SQL text."""

import pytest

from basketlens import __main__ as cli
from basketlens.operators import intervals
from basketlens.plans import jobs
from basketlens.sources import sql, tables as store
from catalog.registered import Shop

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def shop(spark):
    shop = Shop(spark, SF)
    sql.register(spark, shop.tables)
    return shop


def test_views_are_the_operators(spark, shop):
    for name, df in sql.views(shop.tables).items():
        assert spark.table(name).columns == df.columns
    assert sorted(spark.table("purchase_intervals").collect()) == sorted(intervals.purchase_intervals(shop.invoices).collect())


def test_functions_take_parameters(spark, shop):
    gaps = spark.table("purchase_intervals")
    for q in (0.1, 0.5, 0.9):
        want = intervals.churn_threshold(gaps, q).first()
        assert tuple(spark.sql(f"select * from churn_threshold({q}D)").first()) == tuple(want)
    assert spark.sql("select * from churn_threshold()").first()[1] == intervals.churn_threshold(gaps).first()[1]
    assert spark.sql("select count(*) from purchases_of(1)").first()[0] == gaps.where("customer_id = 1").count()
    months = spark.sql("select * from sales_between(date'1996-01-10', date'1996-03-01')").collect()
    assert sorted(str(m.sales_month) for m in months) == ["1996-01-01", "1996-02-01", "1996-03-01"]
    assert spark.sql("select count(*) from sales_between(date'1900-01-01', date'1900-02-01')").first()[0] == 0


def test_filters_reach_the_scan(spark, shop):
    plan = spark.sql("select invoice_no from purchases_of(7)")._jdf.queryExecution().executedPlan().toString()
    assert "o_custkey" in plan.split("PushedFilters")[1]


def test_a_file_of_statements_over_a_load(spark, tmp_path, capsys):
    shop, root = Shop(spark, SF), str(tmp_path / "db")
    store.write_tables(shop.tables, root, buckets=2)
    path = tmp_path / "q.sql"
    path.write_text("create or replace temporary view top as\nselect customer_id, monetary from rfm_features;\n"
                    "select count(*) as customers from top;\n")
    sql.register(spark, store.read_tables(spark, root))
    assert sql.run_file(spark, str(path)).first()[0] == jobs.rfm.rfm_features(shop.invoices, shop.invoice_items).count()
    cli.main(["sql", "--root", root, "--file", str(path)])
    assert "customers" in capsys.readouterr().out
    path.write_text(" ;\n")
    with pytest.raises(ValueError):
        sql.run_file(spark, str(path))
