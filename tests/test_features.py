import random
from decimal import Decimal

import pytest
from pyspark.sql import Window as W, functions as F

from basketlens.operators import intervals, ranking, rfm, sales


def test_cancellations_net_money_but_not_frequency(shop, at):
    invoices, items = shop([
        ("1", 1, at(0), [100, -30]),    # a negative line on an ordinary invoice
        ("C2", 1, at(5), [-20]),
        ("C3", 2, at(6), [-5]),         # nothing but a cancellation
        ("4", None, at(9, 23), [50]),   # a guest moves the snapshot
        ("5", 3, at(8), [7]),
        ("6", 3, at(9), []),            # no lines: no purchase here
    ])
    rows = {r.customer_id: r for r in rfm.rfm_features(invoices, items).collect()}
    assert set(rows) == {1, 3}
    assert (rows[1].recency_days, rows[1].frequency, rows[1].monetary) == (10, 1, Decimal("50.00"))
    assert (rows[3].recency_days, rows[3].frequency, rows[3].monetary) == (2, 1, Decimal("7.00"))
    months = sales.monthly_sales(invoices, items).collect()
    assert [(r.net_sales, r.invoice_count) for r in months] == [(Decimal("102.0000"), 5)]


def test_ntile_of_seven(spark):
    n = F.col("id") + 1
    got = [r[0] for r in spark.range(7).select(ranking.ntile_of(n, F.lit(7), 5)).collect()]
    assert got == [1, 1, 2, 2, 3, 4, 5]
    few = [r[0] for r in spark.range(3).select(ranking.ntile_of(n, F.lit(3), 5)).collect()]
    assert few == [1, 2, 3]


@pytest.mark.parametrize("hot", [0.0, 0.34, 1.0])
def test_global_rank_equals_the_plain_window(spark, hot):
    rng = random.Random(7)
    rows = [(i, Decimal(0) if rng.random() < hot else Decimal(rng.randint(-10**6, 10**6)) / 100) for i in range(3000)]
    df = spark.createDataFrame(rows, "customer_id bigint, v decimal(14,4)")
    order = W.orderBy("v", "customer_id")
    ranked = ranking.global_rank(df, "v", "customer_id")
    tile = ranking.ntile_of(F.col("rank"), F.col("total"), 5)
    both = ranked.withColumn("tile", tile).withColumn("r", F.row_number().over(order)).withColumn(
        "t", F.ntile(5).over(order))
    assert both.filter("rank <> r or tile <> t or total <> 3000").count() == 0
    middle = sorted(float(v) for _, v in rows)
    assert ranking.ranked_median(ranked, "v").first()[0] == pytest.approx((middle[1499] + middle[1500]) / 2)


def test_a_value_shared_by_many_rows_is_split(spark):
    df = spark.range(4000).select(F.col("id").alias("customer_id"), F.lit(0).cast("decimal(14,4)").alias("v"))
    dealt = df.repartitionByRange(16, "v", "customer_id").groupBy(F.spark_partition_id()).count()
    assert dealt.agg(F.max("count")).first()[0] < 1000
    for ranges in (1, 16):
        ranked = ranking.global_rank(df, "v", "customer_id", ranges=ranges).collect()
        assert all(r.rank == r.customer_id + 1 and r.total == 4000 for r in ranked)


def test_intervals_ignore_guests_and_cancellations_and_break_ties(shop, at):
    invoices, _ = shop([
        ("a", 1, at(0, 23), []), ("b", 1, at(2, 1), []), ("d", 1, at(2, 1), []), ("c", 1, at(2, 0), []),
        ("C9", 1, at(3), []), ("e", 1, at(7), []), ("g", None, at(1), []), ("z", 2, at(1), []),
    ])
    rows = {r.invoice_no: r.days_since_prev_purchase for r in intervals.purchase_intervals(invoices).collect()}
    assert rows == {"c": 2, "b": 0, "d": 0, "e": 5}


def test_threshold_rounds_half_even(spark):
    gaps = spark.createDataFrame([(g,) for g in (1, 2, 3)], "days_since_prev_purchase int")
    assert intervals.churn_threshold(gaps, 0.75).first()[:] == (2.5, 2)
    assert intervals.churn_threshold(gaps, 0.9).first()[1] == 3


def test_series_by_country_and_by_product(spark, shop, at):
    invoices, items = shop([("1", 1, at(0), [10, 5]), ("2", 2, at(0), [1]), ("3", None, at(1), [99])])
    customers = spark.createDataFrame([(1, "A"), (2, "B")], "customer_id bigint, country string")
    rows = sales.daily_sales_by(invoices, items, "country", customers, "customer_id").collect()
    assert {(r.series_id, r.net_sales) for r in rows} == {("A", Decimal("15.0000")), ("B", Decimal("1.0000"))}
    rows = sales.daily_sales_by(invoices, items, "stock_code").collect()
    assert {(r.series_id, r.day.day, r.net_sales) for r in rows} == {("p", 1, Decimal("16.0000")), ("p", 2, Decimal("99.0000"))}


def test_no_window_over_all_invoices_of_a_customer(shop, at):
    """The look-back window sees one row per customer and day."""
    invoices, _ = shop([(f"{d}-{n}", 1, at(d, n), []) for d in range(5) for n in range(20)])
    rows = intervals.purchase_intervals(invoices).collect()
    assert len(rows) == 99 and sum(r.days_since_prev_purchase for r in rows) == 4


def test_results_hold_when_one_customer_and_one_invoice_dominate(spark, shop, at):
    rng = random.Random(3)
    rows = [(f"{'C' if n % 13 == 0 else ''}{n}", 1 if n % 2 else rng.randint(2, 60), at(rng.randint(0, 90), rng.randint(0, 5)),
             [rng.randint(1, 9)] * (300 if n == 7 else 1)) for n in range(900)]
    invoices, items = shop(rows)
    lag = F.lag("invoice_date").over(W.partitionBy("customer_id").orderBy("invoice_date", "invoice_no"))
    plain = invoices.filter("not is_cancellation").withColumn("p", lag).filter("p is not null").select(
        "customer_id", "invoice_no", "invoice_date", F.datediff("invoice_date", "p"))
    assert sorted(intervals.purchase_intervals(invoices).collect()) == sorted(plain.collect())

    spend = {}
    for no, customer, _, lines in rows:
        total, purchases = spend.get(customer, (0, 0))
        spend[customer] = (total + sum(lines), purchases + (not no.startswith("C")))
    for lines in (items, rfm.collapse_lines(items)):
        got = {r.customer_id: (r.monetary, r.frequency) for r in rfm.rfm_features(invoices, lines).collect()}
        assert got == {c: v for c, v in spend.items() if v[1]}
