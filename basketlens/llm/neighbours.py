"""Approximate nearest neighbours by a permutation index.

A vector is represented by the order of its nearest pivots. Index rows are dealt into blocks; a block posts each of
its vectors in the inverted files of its nearest pivots, with the place of the pivot. A query visits the files of
its own nearest pivots, sums how well places agree (the footrule distance of the two orders, counted from its
largest value down), and reranks the best share of the block by exact distance. Ten of each block meet per query.

Every row is indexed and every block is asked. Queries travel in blocks too, so a task holds one block of either.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.common import count_blocks, prepare

#: Pivots, a bounded sample: the vectors whose ids have the smallest hashes. Of each order, so many places count.
PIVOTS, PLACES = 256, 64
#: Share of a block that is reranked; vectors that tie with the last of them are reranked too.
SHARE = 0.35
#: Vectors in an index block, and in a block of queries.
INDEX_ROWS, QUERY_ROWS = 16_384, 4_096


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v, times) of the rows that take part: an id, and a vector without null or non-finite parts that isn't
    zero; ``times`` rows have both."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = rows.where("vec_id is not null and v is not null").where(finite & F.exists("v", lambda x: x != 0))
    return rows.groupBy("vec_id", "v").agg(F.count(F.lit(1)).alias("times"))


class BlockIndex:
    """Permutation index of one block: for each pivot, the rows that have it among their nearest, and its place there."""

    def __init__(self, vectors: np.ndarray, pivots: np.ndarray, places: int):
        self.vectors, self.pivots, self.places = vectors, pivots, min(places, len(pivots))
        order = self.order(vectors)
        pivot, row, place = (order.ravel(), np.repeat(np.arange(len(vectors)), self.places),
                             np.tile(np.arange(self.places), len(vectors)))
        by_pivot = np.argsort(pivot, kind="stable")
        ends = np.searchsorted(pivot[by_pivot], np.arange(len(pivots) + 1))
        self.files = [(row[by_pivot[a:b]], place[by_pivot[a:b]]) for a, b in zip(ends, ends[1:])]

    def order(self, vectors: np.ndarray) -> np.ndarray:
        """The nearest pivots of each vector, nearest first; equally near ones in the order of the pivots."""
        distance = (self.pivots ** 2).sum(axis=1) - 2 * vectors @ self.pivots.T
        return np.argsort(distance, axis=1, kind="stable")[:, :self.places]

    def agreement(self, order: np.ndarray) -> np.ndarray:
        """For each row, the largest footrule distance less its own to this order: summed over the posted pivots."""
        total = np.zeros(len(self.vectors), np.int32)
        for mine, pivot in enumerate(order):
            rows, places = self.files[pivot]
            total[rows] += 2 * (self.places - np.maximum(mine, places)).astype(np.int32)
        return total

    def candidates(self, order: np.ndarray, share: float, least: int) -> np.ndarray:
        agreement = self.agreement(order)
        take = min(len(agreement), max(least, int(np.ceil(share * len(agreement)))))
        return np.flatnonzero(agreement >= np.partition(agreement, len(agreement) - take)[len(agreement) - take])


def _search(pivots: np.ndarray, neighbours: int, share: float, places: int):
    schema = pa.schema([("query_id", pa.int64()), ("query_row", pa.int64()), ("query_times", pa.int64()), ("vec_id", pa.int64()),
                        ("score", pa.float64())])

    def matrix(rows: pa.Table) -> np.ndarray:
        return rows["v"].combine_chunks().flatten().to_numpy().reshape(len(rows), -1)

    def run(index: pa.Table, queries: pa.Table) -> pa.Table:
        found = []
        if len(index) and len(queries):
            index = index.sort_by("vec_id")
            ids, block = index["vec_id"].to_numpy(), BlockIndex(matrix(index), pivots, places)
            held = index["times"].to_numpy()
            wanted, row_of, asks = (queries[c].to_numpy() for c in ("vec_id", "query_row", "times"))
            vectors = matrix(queries)
            for q, order in enumerate(block.order(vectors)):
                near = block.candidates(order, share, neighbours + 1)
                # Of the rows that equal the query in id and vector, all but itself.
                others = held[near] - ((ids[near] == wanted[q]) & (block.vectors[near] == vectors[q]).all(axis=1))
                near, others = near[others > 0], others[others > 0]
                score = np.sqrt(((block.vectors[near] - vectors[q]) ** 2).sum(axis=1))
                best = np.lexsort((ids[near], score))[:neighbours]
                best = np.repeat(best, np.minimum(others[best], neighbours))[:neighbours]
                found.append((*(np.full(len(best), c[q]) for c in (wanted, row_of, asks)), ids[near][best], score[best]))
        columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0)] * 5
        return pa.Table.from_arrays([pa.array(c, f.type, safe=False) for c, f in zip(columns, schema)], schema=schema)
    return run


def nearest(vectors: DataFrame, queries: DataFrame, neighbours: int = 10, id_col: str = "vec_id",
            vector_col: str = "embedding", share: float = SHARE, pivots: int = PIVOTS, places: int = PLACES,
            index_rows: int = INDEX_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest found to every query, by Euclidean distance, ties to smaller ids.

    Rows whose vector is null, zero, or holds null or non-finite components take no part, nor do rows without an id;
    vectors of different lengths are an error. A row is never its own neighbour, but any other row may be, also one of
    its id or an equal one; repeated rows count each, as candidates and as queries. Fewer candidates than
    ``neighbours`` give all of them; an empty table gives no rows. Other columns are ignored. With ``share`` = 1 every
    row is reranked, so the answer is exact.
    """
    spark = vectors.sparkSession
    prepare(spark)
    index, asked = usable(vectors, id_col, vector_col), usable(queries, id_col, vector_col)
    lengths = index.agg(F.min(F.size("v")).alias("n"), F.max(F.size("v")).alias("most"), F.count(F.lit(1)).alias("count")).head()
    empty = "query_id long, rank int, vec_id long, score double"
    if not lengths["count"]:
        return spark.createDataFrame([], empty)
    if lengths.n != lengths.most or asked.where(F.size("v") != lengths.n).limit(1).count():
        raise ValueError("vectors have different lengths")
    sample = np.array([r.v for r in index.orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).collect()])
    blocks, parts = count_blocks(lengths["count"], index_rows), count_blocks(asked.count(), query_rows)
    # A tile is one block of the index and one of the queries: both sides bounded, every pair of blocks once.
    index = index.select("vec_id", "v", "times", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).alias("b"),
                         F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("c"))
    asked = asked.select("vec_id", "v", "times", F.xxhash64("vec_id", "v").alias("query_row"),
                         F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("b"))
    asked = asked.withColumn("c", F.pmod("query_row", F.lit(parts)))
    found = index.groupBy("b", "c").cogroup(asked.groupBy("b", "c")).applyInArrow(
        _search(sample, neighbours, share, places), "query_id long, query_row long, query_times long, vec_id long, score double")
    by_query = Window.partitionBy("query_id", "query_row").orderBy("score", "vec_id")
    best = found.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= neighbours)
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("query_times")))
    return best.select("query_id", "rank", "vec_id", "score", each.alias("copy")).drop("copy")
