"""Exact quantiles of several columns without a sort or a shuffle of rows.

Each quantile lies between two order statistics. A pass counts, for every one still sought, the values below its range
and those in each of ``bins`` equal parts of it; the part that holds the rank becomes the next range. When a range
holds few enough different values, a last pass counts these. Every pass is one aggregate with map-side sums, so a task
sends some numbers per quantile, whatever the rows, and a value that a third of all rows share is just a count.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

BINS, FEW, PASSES = 1024, 2000, 40


@dataclass
class _Rank:
    """An order statistic of a column that is sought in [low, high]; ``inside`` of its values lie there."""
    column: str
    rank: int  # from 0 on, among all values
    low: float
    high: float
    inside: int
    value: float | None = None


def _bin(rank: _Rank, bins: int):
    """Number of the equal part of the range that a value lies in, -1 for below, ``bins`` for above."""
    c = F.col(rank.column)
    at = F.least(F.floor((c - F.lit(rank.low)) / F.lit(rank.high - rank.low) * bins), F.lit(bins - 1))
    return F.when(c < rank.low, -1).when(c > rank.high, bins).otherwise(at).cast("int")


def _narrow(df: DataFrame, ranks: list[_Rank], bins: int) -> None:
    """One pass: each range shrinks to the bin that holds its rank, with the true least and largest value of it."""
    parts = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), _bin(r, bins).alias("bin"), F.col(r.column).alias("v"))
                                for i, r in enumerate(ranks)]))
    counts = df.select(parts.alias("p")).select("p.*").where("v is not null").groupBy("i", "bin").agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    found: dict[int, list] = {}
    for row in counts.collect():  # at most bins + 2 rows for each rank
        found.setdefault(row["i"], []).append(row)
    for i, r in enumerate(ranks):
        before = 0
        for row in sorted(found[i], key=lambda x: x["bin"]):
            if before + row["n"] > r.rank:
                r.low, r.high, r.inside = row["low"], row["high"], row["n"]
                break
            before += row["n"]


def _finish(df: DataFrame, ranks: list[_Rank], few: int) -> None:
    """One pass: count the values of small ranges and those below them, and read the ranks off."""
    inside = [F.struct(F.lit(i).alias("i"), F.when(F.col(r.column) < r.low, None).otherwise(F.col(r.column)).alias("v"))
              for i, r in enumerate(ranks)]
    kept = [F.when(F.col(r.column) <= r.high, s) for r, s in zip(ranks, inside)]
    rows = df.select(F.explode(F.array_compact(F.array(*kept))).alias("p")).groupBy("p.i", "p.v").agg(F.count(F.lit(1)).alias("n"))
    found: dict[int, dict] = {}
    for row in rows.collect():  # at most ``few`` different values for each rank, and one row for those below
        found.setdefault(row["i"], {})[row["v"]] = row["n"]
    for i, r in enumerate(ranks):
        before = found[i].pop(None, 0)
        for value, n in sorted(found[i].items()):
            before += n
            if before > r.rank:
                r.value = value
                break


def exact_quantiles(df: DataFrame, wanted: Mapping[str, Sequence[float]], bins: int = BINS, few: int = FEW) -> dict[str, list]:
    """For each column the quantiles, interpolated between neighbouring values as ``percentile`` does.

    NULLs don't count; a column without values gives None; infinite values and NaN are refused. Columns may be of any
    numeric type and are compared as doubles. ``df`` is read a few times: pass a stored frame.
    """
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in wanted])
    figures = doubles.agg(*[f.alias(f"{c}_{n}") for c in wanted for n, f in (
        ("n", F.count(c)), ("low", F.min(c)), ("high", F.max(c)), ("odd", F.count_if(F.isnan(c) | (F.abs(F.col(c)) == math.inf))))]).first()
    ranks: dict[tuple[str, int], _Rank] = {}
    for c, qs in wanted.items():
        if figures[f"{c}_odd"]:
            raise ValueError(f"{c} has values without a size")
        for q in qs:
            if not 0 <= q <= 1:
                raise ValueError("a quantile lies between 0 and 1")
            place = q * (figures[f"{c}_n"] - 1)
            for rank in {math.floor(place), math.ceil(place)} if figures[f"{c}_n"] else ():
                ranks[c, rank] = _Rank(c, rank, figures[f"{c}_low"], figures[f"{c}_high"], figures[f"{c}_n"])
    for _ in range(PASSES):
        wide = [r for r in ranks.values() if r.inside > few and r.low < r.high]
        if not wide:
            break
        _narrow(doubles, wide, bins)
    if ranks:
        _finish(doubles, list(ranks.values()), few)
    out = {}
    for c, qs in wanted.items():
        out[c] = []
        for q in qs:
            if not figures[f"{c}_n"]:
                out[c].append(None)
                continue
            place = q * (figures[f"{c}_n"] - 1)
            low, high = (ranks[c, f(place)].value for f in (math.floor, math.ceil))
            # As the aggregate does it: weights of both neighbours.
            out[c].append(low if low == high else (math.ceil(place) - place) * low + (place - math.floor(place)) * high)
    return out
