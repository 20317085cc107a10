"""Ranked lexical search over posting lists with range-maximum sparse tables.

Documents stay in the partitions they come in. A task turns its documents into shards: per query term a posting list in
document order with integer impacts, and over each list a sparse table of range maxima. A search starts with the
interval of all documents of the shard. The bound of an interval is the sum, over the item's terms, of the largest
impact in it, each one answer of a sparse table. The intervals with the highest bounds are split next, each at the
document that holds the largest of these impacts: that document is scored, the parts before and after it remain as
intervals with bounds of their own. What cannot reach the best documents found so far, of this shard or an earlier one
of the task, is left. Scores are integers and ties go to the smaller id, so the best of all shards are the best of all.

Two passes over the texts' postings give the corpus figures (documents, terms, documents of each term) and the search;
the texts are cut into terms once for each block of items. Items come in blocks of bounded size, which are all that
travels to the tasks; the documents are never moved.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.common import prepare
from basketlens.session import materialize

TOP = 20
#: Bytes of item texts in a block, postings of a shard, intervals split at a time, bytes of a text cut at a time.
ITEM_BYTES, SHARD_POSTINGS, SPLIT_AT_ONCE, PIECE = 4 << 20, 2_000_000, 64, 1 << 20
#: Groups into which an item's best documents of all tasks are dealt before they meet.
SALTS = 64

#: Bytes of terms as they are, A-Z lower-cased, all others a space: digits, letters and every byte of a code point above 7F.
_TERM = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_counts(text: bytes, most: int = PIECE) -> Counter:
    """How often each term occurs in a text, which is cut into terms about ``most`` bytes at a time."""
    counts: Counter = Counter()
    begin = 0
    while begin < len(text):
        end = min(begin + most, len(text))
        while end < len(text) and _TERM[text[end]] != 32:
            end += 1
        counts.update(text[begin:end].translate(_TERM).split())
        begin = end
    return counts


def _postings(numbers: dict[bytes, int]):
    """Per document: its count of terms, the numbers of the item terms it holds, and how often."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, terms, times = [], [], []
            for text in batch.column(1):
                counts = term_counts(text.as_buffer().to_pybytes()) if text.is_valid else {}
                found = [(numbers[t], c) for t, c in counts.items() if t in numbers]
                n.append(sum(counts.values()))
                terms.append(np.array([t for t, _ in found], np.int32).tobytes())
                times.append(np.array([c for _, c in found], np.int64).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(terms, pa.binary()), pa.array(times, pa.binary())],
                ["doc_id", "n", "terms", "times"])
    return run


def _holders(vocabulary: int):
    """(term, documents of this partition that hold it)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for terms in batch.column(0):
                held[np.frombuffer(terms.as_buffer(), np.int32)] += 1
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(held[some])], ["term", "df"])
    return run


class Shard:
    """Posting lists of some documents, in document order, with a sparse table of range maxima over each list."""

    def __init__(self, terms: np.ndarray, docs: np.ndarray, impacts: np.ndarray, n_docs: int):
        order = np.lexsort((docs, terms))
        terms, docs, self.impacts = terms[order], docs[order].astype(np.int64), impacts[order]
        self.n_docs, self.keys = n_docs, terms.astype(np.int64) * n_docs + docs
        self.docs = docs
        # Entry i of level k: the place of the largest of the 2**k impacts from i on. No question crosses the end of
        # a list, so the tables of all lists lie in one array.
        longest = int(np.bincount(terms).max()) if len(terms) else 0
        self.levels = [np.arange(len(docs), dtype=np.int32)]
        for k in range(1, longest.bit_length()):
            half, last = 1 << (k - 1), self.levels[-1]
            a, b = last[:-half], last[half:]
            self.levels.append(np.where(self.impacts[b] > self.impacts[a], b, a))
        width = len(docs)
        self.flat = np.concatenate([np.concatenate([x, np.zeros(width - len(x), np.int32)]) for x in self.levels]) \
            if width else np.zeros(0, np.int32)
        self.width = width

    def spans(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the lists of these terms begin and end."""
        first = terms.astype(np.int64) * self.n_docs
        return np.searchsorted(self.keys, first), np.searchsorted(self.keys, first + self.n_docs)

    def largest(self, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and size of the largest impact in each [begin, end) of a list; size 0 if it is empty."""
        some = end > begin
        length = np.where(some, end - begin, 1)
        level = np.frexp(length.astype(np.float64))[1].astype(np.int64) - 1
        begin = np.where(some, begin, 0)
        base = level * self.width
        left = self.flat[base + begin]
        right = self.flat[base + np.where(some, end - (1 << level), 0)]
        a, b = self.impacts[left], self.impacts[right]
        right_wins = b > a
        return np.where(right_wins, right, left), np.where(some, np.where(right_wins, b, a), 0)


def best_documents(shard: Shard, terms: np.ndarray, weights: np.ndarray, top: int = TOP, floor: int = 0,
                   at_once: int = SPLIT_AT_ONCE) -> list[tuple[int, int]]:
    """(score, document) of the ``top`` best documents with a score of at least ``floor`` and above 0; ties: the first document.

    ``weights``: how often the item holds each of its distinct ``terms``.
    """
    begin, end = shard.spans(terms)
    some = end > begin
    begin, end, weights, first = begin[some], end[some], weights[some], terms[some].astype(np.int64) * shard.n_docs
    best: list[tuple[int, int]] = []  # (-score, document), sorted
    if not len(first):
        return best
    place, size = shard.largest(begin, end)
    # Intervals: bound, first document, and of each term's list the part inside and the place of its largest impact.
    bounds, lows = np.array([(size * weights).sum()]), np.zeros(1, np.int64)
    begins, ends, places, sizes = begin[None], end[None], place[None], size[None]
    least = max(floor, 1)
    while len(bounds):
        if len(bounds) > at_once:
            chosen = np.argpartition(bounds, -at_once)[-at_once:]
        else:
            chosen = np.arange(len(bounds))
        b, e, p, s, low = begins[chosen], ends[chosen], places[chosen], sizes[chosen], lows[chosen]
        row = np.arange(len(chosen))
        split = shard.docs[p[row, (s * weights).argmax(axis=1)]]
        at = np.searchsorted(shard.keys, first + split[:, None])
        inside = np.minimum(at, shard.width - 1)
        here = (at < e) & (shard.keys[inside] == first + split[:, None])
        scores = (np.where(here, shard.impacts[inside], 0) * weights).sum(axis=1)
        for score, doc in zip(scores.tolist(), split.tolist()):
            if score >= least:
                best.append((-score, doc))
        best = sorted(best)[:top]
        if len(best) == top:
            least = max(least, -best[-1][0])
        begin2, end2 = np.concatenate([b, at + here]), np.concatenate([at, e])
        place2, size2 = shard.largest(begin2, end2)
        bound2, low2 = (size2 * weights).sum(axis=1), np.concatenate([low, split + 1])
        rest = np.ones(len(bounds), bool)
        rest[chosen] = False
        bounds, lows = np.concatenate([bounds[rest], bound2]), np.concatenate([lows[rest], low2])
        # An equal bound still counts where its documents come before the last of the best.
        last = best[-1][1] if len(best) == top and -best[-1][0] == least else shard.n_docs
        keep = (bounds > least) | (bounds == least) & (lows < last)
        bounds, lows = bounds[keep], lows[keep]
        begins, ends, places, sizes = (np.concatenate([x[rest], y])[keep] for x, y in (
            (begins, begin2), (ends, end2), (places, place2), (sizes, size2)))
    return [(-score, doc) for score, doc in best]


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def part(times: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """The share of a term's weight that its occurrences in a document of n terms give."""
    if len(n) and int(n.max()) * 25 * n_docs >= 1 << 63:  # beyond 64 bits
        n = n.astype(object)
    long = (100 - 25 + (25 * n * n_docs) // n_terms).astype(np.int64)
    return 1_000_000_000 * times // (1000 * times + 12 * long)


def _search(items: list[tuple[np.ndarray, np.ndarray]], weights: np.ndarray, n_docs: int, n_terms: int, top: int, most: int):
    """(number, doc_id, score): the best documents of a partition for each item."""
    schema = pa.schema([("number", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def searched(held: list, floors: np.ndarray) -> pa.RecordBatch:
        held.sort(key=lambda d: (d[0] is None, d[0] or 0))
        length = np.array([len(d[2]) for d in held])
        doc, n = (np.repeat(x, length) for x in (np.arange(len(held)), np.array([d[1] for d in held], np.int64)))
        terms, times = (np.concatenate([d[i] for d in held]) for i in (2, 3))
        shard = Shard(terms, doc, weights[terms] * part(times, n, n_docs, n_terms), len(held))
        rows = []
        for number, (of, often) in enumerate(items):
            found = best_documents(shard, of, often, top, int(floors[number]))
            if len(found) == top:
                floors[number] = max(floors[number], found[-1][0])
            rows += [(number, held[d][0], score) for score, d in found]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 3, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total, floors = [], 0, np.zeros(len(items), np.int64)
        for batch in batches:
            for doc, n, terms, times in zip(*(c.to_pylist() for c in batch.columns)):
                if terms:
                    held.append((doc, n, np.frombuffer(terms, np.int32), np.frombuffer(times, np.int64)))
                    total += len(held[-1][2])
                if total >= most:
                    yield searched(held, floors)
                    held, total = [], 0
        if held:
            yield searched(held, floors)
    return run


def _best(found: DataFrame, top: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _search_block(docs: DataFrame, items: list[tuple], top: int, shard_postings: int) -> DataFrame | None:
    """Results for the items (item_id, text) of one block."""
    spark = docs.sparkSession
    counts = [term_counts((text or "").encode("utf-8", "replace")) for _, text in items]
    numbers = {t: i for i, t in enumerate(sorted(set().union(*counts)))}
    if not numbers:
        return None
    asked = [(np.array([numbers[t] for t in c], np.int64), np.array(list(c.values()), np.int64)) for c in counts]
    postings = materialize(docs.mapInArrow(_postings(numbers), "doc_id bigint, n bigint, terms binary, times binary"), "postings")
    n_docs, n_terms = postings.agg(F.count_if(F.col("n") > 0), F.sum("n")).head()
    if not n_docs:
        return None
    held = postings.where(F.length("terms") > 0)
    df = held.select("terms").mapInArrow(_holders(len(numbers)), "term int, df bigint").groupBy("term").agg(F.sum("df").alias("df"))
    weights = np.zeros(len(numbers), np.int64)
    for term, n in df.collect():  # at most one row for each term of the block
        weights[term] = weight(n_docs, n)
    found = held.mapInArrow(_search(asked, weights, n_docs, n_terms, top, shard_postings), "number int, doc_id bigint, score bigint")
    found = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS)))
    found = _best(_best(found, top, "number", "salt").drop("rank"), top, "number")
    names = spark.createDataFrame([(i, k) for i, (k, _) in enumerate(items)], "number int, item_id bigint")
    return found.join(F.broadcast(names), "number").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text", item_bytes: int = ITEM_BYTES,
           shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """item_id, rank, doc_id, score: for every item its ``top`` highest-scoring documents with a score above 0.

    Terms are the maximal runs of digits, letters and code points above 7F in the whole text, only A-Z lower-cased; null
    texts have none. A document's score is the sum over the item's terms, repeats included, of
    w * ((10**9 * tf) div (1000 * tf + 12 * m)), with w = floor(1000 * ln((2 N + 2) / (2 df + 1))) and
    m = 75 + (25 n N) div L, where N counts the documents with terms, L their terms, n those of the document, df the
    documents that hold the term and tf its occurrences. Equal scores rank by id, null ids last; repeated rows of
    documents rank each for itself, repeated items give repeated results. Items without terms or hits give no rows; an
    empty table of documents or items gives none; other columns are ignored. Long texts are cut piece by piece.
    Each block of about ``item_bytes`` of items is one pass over all documents.
    """
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    items = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text"))
    total = items.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 8)).head()[0] or 0
    blocks = max(1, math.ceil(total / item_bytes))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    found = [_search_block(docs, [tuple(r) for r in items.where(block == k).collect()], top, shard_postings) for k in range(blocks)]
    found = [materialize(x, "ranked") if blocks > 1 else x for x in found if x is not None]
    empty = spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    return reduce(DataFrame.unionByName, found) if found else empty
