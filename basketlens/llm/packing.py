"""Packing documents into sequences of a fixed number of words: best fit under conflicts.

No bin holds two pieces of one source or of one cluster of duplicates. Open bins are ordered by residual space and
carry two bitmaps, of the sources and of the clusters they hold; the search for a piece begins at the smallest
residual that holds it and goes on to the next larger one until a bin without conflict is found, which so is the
tightest compatible bin. Each residual also keeps the bits that all its bins share, to pass over it at once.

Pieces are dealt by a hash to shards of bounded size, and each shard is packed on its own.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import count_blocks, flat, pieces, prepare, word_spans
from basketlens.session import materialize

#: Words of a sequence, and pieces that one task packs together.
CAPACITY, SHARD_ROWS = 2048, 16_384


class Bins:
    """Open bins in the order of their residual space; bins of one residual in the order of their numbers."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.residual: list[int] = []  # by bin
        self.sources: list[int] = []  # bitmaps, by bin
        self.clusters: list[int] = []
        self.levels: list[int] = []  # residuals that some open bin has, ascending
        self.at: dict[int, list[int]] = {}  # residual -> bins, ascending
        self.shared: dict[int, tuple[int, int]] = {}  # residual -> bits that all its bins have, or fewer

    def tightest(self, length: int, source: int, cluster: int) -> int:
        """The compatible bin with the smallest residual that holds ``length``; -1 if there is none."""
        for level in self.levels[bisect_left(self.levels, length):]:
            sources, clusters = self.shared[level]
            if sources & source or clusters & cluster:
                continue
            sources = clusters = -1
            for bin_ in self.at[level]:
                if not (self.sources[bin_] & source or self.clusters[bin_] & cluster):
                    return bin_
                sources &= self.sources[bin_]
                clusters &= self.clusters[bin_]
            self.shared[level] = (sources, clusters)
        return -1

    def put(self, length: int, source: int, cluster: int) -> tuple[int, int]:
        """Bin and first word of a piece."""
        bin_ = self.tightest(length, source, cluster)
        if bin_ < 0:
            bin_ = len(self.residual)
            self.residual.append(self.capacity), self.sources.append(0), self.clusters.append(0)
        else:
            level = self.residual[bin_]
            held = self.at[level]
            del held[bisect_left(held, bin_)]
            if not held:
                del self.at[level], self.shared[level], self.levels[bisect_left(self.levels, level)]
        start = self.capacity - self.residual[bin_]
        self.residual[bin_] -= length
        self.sources[bin_] |= source
        self.clusters[bin_] |= cluster
        level = self.residual[bin_]
        if level:
            if level not in self.at:
                self.at[level], self.shared[level] = [], (-1, -1)
                insort(self.levels, level)
            insort(self.at[level], bin_)
            sources, clusters = self.shared[level]
            self.shared[level] = (sources & self.sources[bin_], clusters & self.clusters[bin_])
        return bin_, start


def bits(values: list) -> list[int]:
    """One bit for each value that occurs more than once; nulls, and what occurs once, conflict with nothing."""
    often = [v for v, n in Counter(values).items() if n > 1 and v is not None]
    bit = {v: 1 << i for i, v in enumerate(sorted(often, key=str))}
    return [bit.get(v, 0) for v in values]


def pack_shard(lengths: list[int], sources: list, clusters: list, capacity: int) -> list[tuple[int, int]]:
    """(bin, first word) of each piece; pieces have to come in the order of packing."""
    bins = Bins(capacity)
    return [bins.put(*piece) for piece in zip(lengths, bits(sources), bits(clusters))]


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rid, doc_id, source, cluster, text) with the text's words counted; the text goes on if asked for."""
    for batch in batches:
        data, offsets = flat(batch.column(4))
        counts = [np.diff(word_spans(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])[2])
                  for a, b in pieces(offsets)]
        length = pa.array(np.concatenate(counts).astype(np.int64) if counts else [], pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], length, *batch.columns[5:]],
                                         ["rid", "doc_id", "source", "cluster", "length", *batch.schema.names[5:]])


def _pack(capacity: int):
    def run(shard: pa.Table) -> pa.Table:
        shard = shard.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"),
                               ("cluster", "ascending"), ("source", "ascending"), ("rid", "ascending")])
        placed = pack_shard(shard["length"].to_pylist(), shard["source"].to_pylist(), shard["cluster"].to_pylist(), capacity)
        bin_, start = zip(*placed)
        number = shard["shard"].to_numpy() * (1 << 32) + np.array(bin_, np.int64)
        return pa.table({"doc_id": shard["doc_id"], "piece": shard["piece"], "length": shard["length"],
                         "bin": pa.array(number), "start": pa.array(start, pa.int64()), "rid": shard["rid"]})
    return run


def _pieces(capacity: int):
    """One row for each piece of a document, with the piece's words; rows: doc_id, text, placed."""
    names = ["doc_id", "piece", "length", "bin", "start", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, placed in zip(*(c.to_pylist() for c in batch.columns)):
                words = text.encode("utf-8", "replace").split()  # of bytes: at \x20 and \x09-\x0D
                for p in placed:
                    part = words[p["piece"] * capacity:p["piece"] * capacity + p["length"]]
                    rows.append((doc_id, p["piece"], p["length"], p["bin"], p["start"], b" ".join(part).decode("utf-8", "replace")))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if n == "text" else pa.int64())
                                              for c, n in zip(zip(*rows) if rows else [[]] * 6, names)], names)
    return run


def pack(docs: DataFrame, capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS, id_col: str = "doc_id",
         text_col: str = "text", source_col: str = "source", cluster_col: str | None = None, words: bool = False) -> DataFrame:
    """doc_id, piece, length, bin, start: where each document goes, in words `[^\\x20\\x09-\\x0D]+`; with ``words`` also
    text, the words of the piece, joined by one space.

    Longest pieces first, ties by doc_id. A document longer than ``capacity`` is cut into pieces of ``capacity``
    words and a rest; its piece ``piece`` begins at word ``piece * capacity``. Documents with equal values in
    ``cluster_col``, a component of near copies for instance, are one cluster; without it those with equal texts are. A
    null source or cluster conflicts with nothing. A text without words, or null, has one piece of length 0 and
    null ``bin`` and ``start``. Null ids pack like others; repeated rows are copies of each other, so they never
    share a bin; an empty table gives no rows; other columns are ignored. Every piece is packed, so what no bin
    takes opens a new one. Memory of a task is bounded by ``shard_rows``, and by one text.
    """
    prepare(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    cluster = F.xxhash64(text) if cluster_col is None else F.when(F.col(cluster_col).isNotNull(), F.xxhash64(cluster_col))
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("doc_id"),
                       F.col(source_col).cast("string").alias("source"), cluster.alias("cluster"), text.alias("text"),
                       *([text.alias("kept")] if words else []))
    schema = "rid bigint, doc_id bigint, source string, cluster bigint, length bigint" + ", kept string" * words
    rows = materialize(rows.mapInArrow(_lengths, schema), "lengths")
    whole = F.ceil(F.col("length") / capacity).cast("long")
    cut = rows.where("length > 0").drop("kept").select("*", F.explode(F.sequence(F.lit(0).cast("long"), whole - 1)).alias("piece"))
    cut = cut.withColumn("length", F.least(F.lit(capacity).cast("long"), F.col("length") - F.col("piece") * capacity))
    total = rows.where("length > 0").agg(F.sum(whole)).head()[0] or 0
    shards = count_blocks(total, shard_rows)
    cut = cut.withColumn("shard", F.pmod(F.xxhash64("doc_id", "cluster", "piece", "rid"), F.lit(shards)))
    placed = cut.groupBy("shard").applyInArrow(
        _pack(capacity), "doc_id bigint, piece bigint, length bigint, bin bigint, start bigint, rid bigint")
    empty = rows.where("length = 0").selectExpr("doc_id", "0L as piece", "length", "cast(null as bigint) as bin",
                                                "cast(null as bigint) as start", "rid")
    placed = placed.unionByName(empty)
    if not words:
        return placed.drop("rid")
    where = placed.groupBy("rid").agg(F.collect_list(F.struct("piece", "length", "bin", "start")).alias("placed"))
    return rows.select("rid", "doc_id", "kept").join(where, "rid").select("doc_id", "kept", "placed").mapInArrow(
        _pieces(capacity), "doc_id bigint, piece bigint, length bigint, bin bigint, start bigint, text string")
