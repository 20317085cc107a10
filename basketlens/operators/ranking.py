"""Exact global rank, n-tile and median without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from basketlens.session import materialize

def global_rank(df: DataFrame, value: str, tie: str, rank: str = "rank", total: str = "total",
                ranges: int | None = None) -> DataFrame:
    """Add the 1-based rank by ``(value, tie)`` and the row count. Both columns must be non-null.

    Rows are dealt to ranges of ``(value, tie)``, so a value that a third of the rows share still spreads over
    many; there are as many ranges as the session has shuffle partitions, or ``ranges``. Rows are ranked inside
    their range and shifted by the rows of earlier ranges. The borders, which Spark draws from a sample, only
    decide how even the ranges are, never the rank. The dealt rows are stored, so both reads see the same ranges.
    """
    dealt = df.repartitionByRange(ranges, value, tie) if ranges else df.repartitionByRange(value, tie)
    dealt = materialize(dealt.withColumn("_range", F.spark_partition_id()), "ranges")
    ordered = W.orderBy("_range")  # one row per range
    offsets = dealt.groupBy("_range").agg(F.count("*").alias("_n")).select(
        "_range",
        F.coalesce(F.sum("_n").over(ordered.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("_n").over(ordered.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)).alias(total),
    )
    inside = F.row_number().over(W.partitionBy("_range").orderBy(value, tie))
    return (
        dealt.withColumn("_inside", inside)
        .join(F.broadcast(offsets), "_range")
        .withColumn(rank, F.col("_before") + F.col("_inside"))
        .drop("_range", "_before", "_inside")
    )


def ntile_of(rank: Column, total: Column, tiles: int) -> Column:
    """The n-tile of a rank: the first ``total mod tiles`` tiles hold one row more than the others."""
    small = F.floor(total / tiles)
    larger = total - small * tiles
    head = larger * (small + 1)
    return (
        F.when(rank <= head, F.ceil(rank / (small + 1)))
        .otherwise(larger + F.ceil((rank - head) / F.greatest(small, F.lit(1))))
        .cast("int")
    )


def ranked_median(ranked: DataFrame, value: str, rank: str = "rank", total: str = "total") -> DataFrame:
    """Exact median of the ranked column: the mean of the middle one or two rows."""
    middle = F.col(rank).between(F.floor((F.col(total) + 1) / 2), F.floor(F.col(total) / 2) + 1)
    return ranked.filter(middle).agg(F.avg(F.col(value).cast("double")).alias(value))
