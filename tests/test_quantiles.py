"""Quantiles by narrowing against the aggregate that keeps all values."""

import math
import random

import pytest
from pyspark.sql import functions as F

from basketlens.operators.quantiles import exact_quantiles

QS = [0, 0.1, 0.25, 0.5, 0.9, 0.99, 1]


@pytest.mark.parametrize("bins, few", [(1024, 2000), (4, 3), (2, 1)])
def test_equal_to_the_aggregate(spark, bins, few):
    draw = random.Random(bins)
    rows = [(draw.choice([1, 2, 2, 2, 3, 900]), draw.gauss(0, 1) * 10 ** draw.randint(-9, 9), round(draw.uniform(-5, 5), 2),
             draw.choice([None, 1.5, -7.25]), 4, None) for _ in range(3001)]
    df = spark.createDataFrame(rows, "a int, b double, c double, d double, e long, f double").withColumn(
        "c", F.col("c").cast("decimal(12,4)")).repartition(5).cache()
    got = exact_quantiles(df, {c: QS for c in "abcdef"}, bins, few)
    for c in "abcde":
        want = [df.agg(F.percentile(c, q)).first()[0] for q in QS]
        assert got[c] == pytest.approx(want, rel=1e-14, abs=0), c
    assert got["f"] == [None] * len(QS)


def test_few_rows_and_values_without_size(spark):
    for values in ([3.0], [1.0, 2.0], [5.0] * 10):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        assert exact_quantiles(df, {"x": [0.5, 0.9]}) == {"x": [df.agg(F.percentile("x", q)).first()[0] for q in (0.5, 0.9)]}
    assert exact_quantiles(spark.createDataFrame([], "x double"), {"x": [0.5]}) == {"x": [None]}
    for odd in (math.nan, math.inf):
        with pytest.raises(ValueError, match="without a size"):
            exact_quantiles(spark.createDataFrame([(odd,), (1.0,)], "x double"), {"x": [0.5]})
    with pytest.raises(ValueError):
        exact_quantiles(spark.createDataFrame([(1.0,)], "x double"), {"x": [1.5]})


def test_no_row_is_sorted_or_moved(spark, monkeypatch):
    df = spark.range(100_000).select((F.col("id") % 7919).alias("x"))
    want, plans = [df.agg(F.percentile("x", 0.5)).first()[0]], []
    from pyspark.sql.classic.dataframe import DataFrame
    collect = DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: (plans.append(self._jdf.queryExecution().executedPlan().toString()), collect(self))[1])
    assert exact_quantiles(df, {"x": [0.5]}, bins=16, few=10)["x"] == want
    assert len(plans) > 3 and not any("rangepartitioning" in p or "Sort " in p for p in plans)
    assert all("partial_count" in p for p in plans)
