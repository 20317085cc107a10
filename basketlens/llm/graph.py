"""Connected components of an edge list, with the work spread over Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.session import materialize

#: Rounds after which a graph is given up; each at least halves what is left to contract.
MOST_ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours on the smallest one near: the larger neighbours of each node, or the smaller ones and itself."""
    if large:
        edges = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = edges.groupBy("a").agg(F.least("a", F.min("b")).alias("root"))
        moved = edges.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("root"))
        moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b"))
        moved = moved.unionByName(least.select("a", F.col("root").alias("b")))
    return moved.where("a > b").distinct()


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root): every node of the undirected edges (a, b) with the smallest node of its component.

    Alternating large and small stars; a node with very many neighbours is summed map-side and its rows are split
    by adaptive execution, none is ever collected. Each round is written to the shared folder, so lineage stays
    short. Nodes may be numbers, strings or binary. Loops and repeated edges do no harm; no edges give no rows.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = materialize(edges, f"{name}-edges")
    seen = None
    for _ in range(MOST_ROUNDS):
        state = edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))"), F.min("a"),
                          F.expr("sum(cast(xxhash64(b, a) as decimal(38)))")).head()
        if tuple(state) == seen:
            roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = tuple(state)
        edges = materialize(_star(_star(edges, True), False), f"{name}-edges")
    raise RuntimeError(f"no fixed point after {MOST_ROUNDS} rounds")
