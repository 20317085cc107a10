"""Repeated passages by compaction of a De Bruijn graph of words.

Every window of ``window`` words is an edge of the graph, from the node of its first ``window`` - 1 words to that of its
last. Only edges that occur more than once matter, and they are found in three steps. Consecutive windows of a text with
the same least k-mer make a run; equal windows have equal least k-mers, so runs of a k-mer that occurs once are left at
once. Runs with the same words are one path of edges, repeated as a whole. Where runs of one k-mer differ, the windows
of each different run are unpacked to single edges and counted.

Joins with the degrees of the nodes then compact the graph: edges that follow one another in the text that holds them
first, across a node with one edge in and one out, become one path. Each text's occurrences of a path, contiguous
again, are one span with the coordinates of the path's source. Before a word goes, the words of every span are compared
(by SHA-256) with the words at its source coordinates.

Runs and windows are told apart by 128 bits (e1, e2) from 128 bits for each word, texts by 94 bits (k1, k2) of their
SHA-256; the 64-bit hashes of k-mers only gather, and the 32 bits of a node only say where paths end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.common import HOT, flat, fresh, lookup, pieces, prepare, run_hashes, texts, texts_of, word_hashes, word_spans
from basketlens.session import materialize

#: Words of a repeated window, and of the k-mers by which windows are gathered.
WINDOW, KMER = 35, 11
#: Tasks over which the further runs of a k-mer that is frequent in one batch are spread.
SALTS = 64
#: Spans of a frequent text up to which it is looked up by broadcast.
FEW_SPANS = 64


def least_kmers(hashes: np.ndarray, window: int, kmer: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the k-mer at each word, and the least of them in the window that begins there (shorter at the end)."""
    kmers = run_hashes(hashes, kmer)
    width, have, least = window - kmer + 1, 1, kmers
    while have < width and len(least):
        step = min(have, width - have)
        moved = least[step:]
        least = np.concatenate([np.minimum(least[:len(moved)], moved), least[len(moved):]])
        have += step
    return kmers, least


class Words:
    """Words of some texts, one after the other, as hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        starts, ends, self.first = word_spans(data, offsets)
        self.counts, self.hashes = np.diff(self.first), word_hashes(data, starts, ends)
        self.plain = np.ascontiguousarray(self.hashes[:, 0])


def runs(words: Words, window: int, kmer: int) -> tuple[np.ndarray, ...]:
    """Maximal runs of windows with one least k-mer: text, first word (of all texts), windows, that k-mer, and how
    often it occurs in the run."""
    first, counts = words.first, words.counts
    kmers, least = least_kmers(words.plain, window, kmer)
    text_of = np.repeat(np.arange(len(counts)), counts)[:len(least)]
    valid = np.flatnonzero(np.arange(len(least)) - first[:-1][text_of] + window <= counts[text_of])
    if not len(valid):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    value, text_of = least[valid], text_of[valid]
    new = np.ones(len(valid), bool)
    new[1:] = (value[1:] != value[:-1]) | (text_of[1:] != text_of[:-1])
    begin = np.flatnonzero(new)
    windows = np.diff(np.append(begin, len(valid)))
    start, value, text_of = valid[begin], value[begin], text_of[begin]
    # Places of the least k-mer within each run: of all k-mers that belong to it, those with its value.
    reach = windows + window - kmer
    base = np.concatenate([[0], np.cumsum(reach)[:-1]])
    at = np.repeat(start - base, reach) + np.arange(reach.sum())
    places = np.add.reduceat((kmers[at] == np.repeat(value, reach)).astype(np.int64), base)
    return text_of, start, windows, value, np.minimum(places, 2)


EDGE = {"k1": pa.int64(), "k2": pa.int32(), "start": pa.int32(), "windows": pa.int32(), "e1": pa.int64(), "e2": pa.int64(),
        "tail": pa.int32(), "head": pa.int32()}
EDGE_TYPE = "k1 bigint, k2 int, start int, windows int, e1 bigint, e2 bigint, tail int, head int"


def _edges(words: Words, row: np.ndarray, keys: list[pa.Array], start: np.ndarray, windows: np.ndarray, edge: np.ndarray,
           window: int) -> list[pa.Array]:
    """Columns of EDGE for ranges of windows; ``start`` counts the words of all texts, ``edge`` has two columns."""
    nodes = run_hashes(words.plain, window - 1).astype(np.uint32).view(np.int32) if window > 1 else np.zeros(len(words.plain) + 1, np.int32)
    values = [start - words.first[row], windows, *edge.view(np.int64).T, nodes[start], nodes[start + windows]]
    return [k.take(pa.array(row)) for k in keys] + [pa.array(v.astype(t.to_pandas_dtype())) for v, t in zip(values, list(EDGE.values())[2:])]


def _runs(window: int, kmer: int):
    """Runs as edges, with their k-mer, whether it is repeated for sure, and a salt.

    Of a k-mer that a batch has more than once, one row goes out unsalted to say so and the others need not meet it.
    """
    def listed(batch: pa.RecordBatch) -> list[list[pa.Array]]:
        data, offsets = flat(batch.column(2))
        out = []
        for a, b in pieces(offsets):
            words = Words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            text, start, windows, value, places = runs(words, window, kmer)
            raw = memoryview(np.ascontiguousarray(words.hashes).view(np.uint8).reshape(-1))
            digests = b"".join(hashlib.blake2b(raw[16 * i:16 * j], digest_size=16).digest()
                               for i, j in zip(start.tolist(), (start + windows + window - 1).tolist()))
            edge = np.frombuffer(digests, np.uint64).reshape(-1, 2)
            keys = [batch.column(i).slice(a, b - a) for i in (0, 1)]
            out.append([*_edges(words, text, keys, start, windows, edge, window), pa.array(value.view(np.int64)), pa.array(places)])
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not (parts := listed(batch)):
                continue
            columns = [pa.concat_arrays(c) for c in zip(*parts)]
            kmers, places = columns[-2].to_numpy(), columns[-1].to_numpy()
            _, first, number, times = np.unique(kmers, return_index=True, return_inverse=True, return_counts=True)
            sure = (times[number] > 1) | (places > 1)
            salt = np.arange(len(kmers)) % SALTS + 1
            salt[times[number] == 1] = 0
            salt[first] = 0
            yield pa.RecordBatch.from_arrays(
                [*columns[:-1], pa.array(places.astype(np.int32)), pa.array(sure), pa.array(salt.astype(np.int32))],
                [*EDGE, "kmer", "places", "sure", "salt"])
    return run


def _windows(window: int):
    """Every window of the asked runs of a text as an edge; rows: k1, k2, text, asked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch.column(2))
            asked = batch.column(3).to_pylist()
            for a, b in pieces(offsets):
                words = Words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                row, begin, count, times = (np.array(x, np.int64) for x in zip(*(
                    (i - a, s["start"], s["windows"], s["times"]) for i in range(a, b) for s in asked[i])))
                row, times = np.repeat(row, count), np.repeat(times, count)
                start = words.first[row] + np.repeat(begin - np.cumsum(count) + count, count) + np.arange(count.sum())
                edge = np.stack([run_hashes(np.ascontiguousarray(words.hashes[:, i]), window)[start] for i in (0, 1)], axis=1)
                keys = [batch.column(i).slice(a, b - a) for i in (0, 1)]
                columns = _edges(words, row, keys, start, np.ones(len(row), np.int64), np.ascontiguousarray(edge), window)
                yield pa.RecordBatch.from_arrays([*columns, pa.array(times)], [*EDGE, "times"])
    return run


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text once for each partition, so that copies don't travel; rows: k1, k2, text."""
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        new = []
        for i, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
            if key not in seen:
                seen.add(key)
                new.append(i)
        yield batch.take(pa.array(new, pa.int64()))


def keys_of(text: Column) -> list[Column]:
    """94 bits of the SHA-256 of a text, as two numbers from 0 on: with a place in the text they fit into one decimal."""
    digest = F.sha2(text.cast("binary"), 256)
    number = [F.conv(F.substring(digest, at, n), 16, -10).cast("bigint") for at, n in ((1, 16), (17, 8))]
    return [F.shiftrightunsigned(number[0], 1), F.shiftrightunsigned(number[1], 1).cast("int")]


def keyed(text: Column, docs: DataFrame) -> DataFrame:
    return docs.select(text.alias("text")).select(*[k.alias(n) for k, n in zip(keys_of(F.col("text")), KEY)], "text")


KEY, NAME = ["k1", "k2"], ["e1", "e2"]
#: Coordinates (k1, k2, start) as one number, 62 bits for the last two.
PLACE = "cast(k1 as decimal(38,0)) * 4611686018427387904 + (k2 * 2147483648L + start)"


def _sourced(df: DataFrame) -> DataFrame:
    """``source``, the least PLACE of a group, as coordinates k1, k2, start."""
    rest = F.expr("cast(source % 4611686018427387904 as bigint)")
    return df.withColumns({"k1": F.expr("source div 4611686018427387904"), "k2": F.shiftright(rest, 31).cast("int"),
                           "start": (rest % F.lit(1 << 31)).cast("int")}).drop("source")


def repeated_edges(rows: DataFrame, window: int = WINDOW, kmer: int = KMER) -> tuple[DataFrame, DataFrame]:
    """(places, edges) of the graph of repeated windows of (k1, k2, text).

    places: k1, k2, start, windows, e1, e2, which of them are places of these edges a join tells. edges: e1, e2, windows,
    tail, head, times, the coordinates k1, k2, start of one place, the source, and whether the edge is a single window of a
    branching run.
    """
    listed = rows.mapInArrow(_runs(window, kmer), f"{EDGE_TYPE}, kmer bigint, places int, sure boolean, salt int")
    meeting = F.count(F.lit(1)).over(Window.partitionBy("kmer", "salt"))
    met = listed.withColumn("meeting", meeting).where("sure or meeting > 1").drop("sure", "salt", "meeting")
    met = materialize(met, "shared-kmers")
    # Numbers alone: such an aggregate hashes and needs no sort. All rows of an edge agree in what is taken as first.
    source = [*[F.first(c).alias(c) for c in ("windows", "tail", "head")], F.min(F.expr(PLACE)).alias("source")]
    contents = materialize(_sourced(met.groupBy(*NAME).agg(
        F.first("kmer").alias("kmer"), F.count(F.lit(1)).alias("times"), F.max("places").alias("places"), *source)), "distinct-runs")
    whole = contents.where("times > 1")
    columns = [*KEY, "start", "windows", *NAME]
    # A run that occurs once may still share windows with the other runs of its k-mer, or with itself.
    branching = contents.groupBy("kmer").agg(F.min("times").alias("least"), F.count(F.lit(1)).alias("runs"), F.max("places").alias("places"))
    branching = branching.where("least = 1 and (runs > 1 or places > 1)").select("kmer")
    asked = contents.join(branching, "kmer").groupBy(*KEY).agg(
        F.collect_list(F.struct("start", "windows", "times")).alias("asked"))  # at most one run for each word
    asked = materialize(asked, "branching-runs")
    # The source coordinates lead back to the words themselves.
    once = rows.mapInArrow(_once, "k1 bigint, k2 int, text string")
    found = once.join(asked, KEY).dropDuplicates(KEY).mapInArrow(_windows(window), f"{EDGE_TYPE}, times bigint")
    found = materialize(found, "windows")
    again = found.groupBy(*NAME).agg(F.sum("times").alias("times"), F.min("times").alias("least"), *source)
    again = materialize(_sourced(again.where("times > 1 and least = 1").drop("least")), "repeated-windows")
    edges = [*NAME, "windows", "tail", "head", "times", *KEY, "start"]
    return met.select(columns).unionByName(found.where("times = 1").select(columns)), whole.select(*edges, F.lit(False).alias("single")).unionByName(
        again.select(*edges, F.lit(True).alias("single")))


def compacted(edges: DataFrame) -> DataFrame:
    """(e1, e2, times, of1, of2, begins, place): the path of each edge, named by its source coordinates, and the windows of the
    path before it.

    An edge follows the one before it in its source text if nothing else enters or leaves the node between them.
    """
    out = edges.groupBy(F.col("tail").alias("node")).agg(F.count(F.lit(1)).alias("out"))
    into = edges.groupBy(F.col("head").alias("node")).agg(F.count(F.lit(1)).alias("into"))
    plain = out.where("out = 1").join(into.where("into = 1"), "node").select("node")
    marked = edges.join(plain, edges["tail"] == plain["node"], "left").select(
        *NAME, "times", "windows", "head", "tail", F.col("k1").alias("of1"), F.col("k2").alias("of2"), "start",
        F.col("node").isNotNull().alias("plain"), "single")
    # A single window may have its source inside a longer run. As many rows as a text has words, at most.
    order = Window.partitionBy("of1", "of2", "single").orderBy("start")
    follows = F.col("plain") & (F.lag("head").over(order) == F.col("tail")) & (
        F.lag(F.col("start") + F.col("windows")).over(order) == F.col("start"))
    marked = marked.withColumn("begins", F.when(F.coalesce(follows, F.lit(False)), None).otherwise(F.col("start")))
    begun = marked.withColumn("begins", F.last("begins", True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return begun.select(*NAME, "times", "of1", "of2", "begins", (F.col("start") - F.col("begins")).alias("place"))


def repeated_spans(rows: DataFrame, window: int = WINDOW, kmer: int = KMER) -> DataFrame:
    """(k1, k2, start, end, of1, of2, at): word ranges of repeated windows, and the source coordinates of the same words."""
    places, edges = repeated_edges(rows, window, kmer)
    on_path = lookup(places, compacted(edges), NAME, "times").select(
        *KEY, "start", (F.col("start") + F.col("windows")).alias("end"), "of1", "of2",
        (F.col("begins") - F.col("start") + F.col("place")).alias("shift"), "begins").distinct()
    order = Window.partitionBy(*KEY, "of1", "of2", "begins", "shift").orderBy("start")
    apart = F.coalesce(F.lag("end").over(order) != F.col("start"), F.lit(True))
    number = F.sum(F.when(apart, 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    spans = on_path.withColumn("number", number).groupBy(*KEY, "of1", "of2", "begins", "shift", "number").agg(
        F.min("start").alias("start"), F.max("end").alias("end"))
    return spans.select(*KEY, "start", (F.col("end") + (window - 1)).alias("end"), "of1", "of2",
                        (F.col("start") + F.col("shift")).alias("at"))


def _cut(words: list[bytes], spans: list) -> tuple[int, bytes]:
    """Removed words, and the kept words joined by one space."""
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, [s["start"] for s in spans], 1)
    np.add.at(edge, [s["end"] for s in spans], -1)
    kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
    return len(words) - len(kept), b" ".join([words[i] for i in kept])


class Spelled:
    """The words of one text, and digests of word ranges."""

    def __init__(self, text: bytes):
        self.words = text.split()  # of bytes: at \x20 and \x09-\x0D
        self.joined = memoryview(b" ".join(self.words))
        length = np.fromiter(map(len, self.words), np.int64, len(self.words))
        self.ends = np.cumsum(length + 1) - 1
        self.starts = self.ends - length

    def digests(self, begin: np.ndarray, end: np.ndarray) -> list[bytes]:
        """SHA-256 of the words [begin, end) of each range, joined by one space."""
        return [hashlib.sha256(self.joined[a:b]).digest() for a, b in zip(self.starts[begin].tolist(), self.ends[end - 1].tolist())]


DONE = {"n_words": "bigint", "n_removed": "bigint", "kept": "string",
        "checks": "array<struct<of1: bigint, of2: int, at: int, words: int, digest: binary>>"}
SPAN = ("start", "end", "of1", "of2", "at", "goes")


def _done(names: list[str]):
    """Cut texts, and digests of the words at coordinates to be compared; columns: any, then text, spans."""
    check = pa.list_(pa.struct([("of1", pa.int64()), ("of2", pa.int32()), ("at", pa.int32()), ("words", pa.int32()), ("digest", pa.binary())]))

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text, spans in zip(texts_of(batch.column(batch.num_columns - 2)), batch.column(batch.num_columns - 1).to_pylist()):
            if not spans:
                words = text.split()
                rows.append((len(words), 0, b" ".join(words), []))
                continue
            held = Spelled(text)
            made = held.digests(*(np.array([s[k] for s in spans], np.int64) for k in ("start", "end")))
            checks = [{"of1": s["of1"], "of2": s["of2"], "at": s["at"], "words": s["end"] - s["start"], "digest": d}
                      for s, d in zip(spans, made)]
            rows.append((len(held.words), *_cut(held.words, [s for s in spans if s["goes"]]), checks))
        n, removed, kept, checks = zip(*rows) if rows else ((),) * 4
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:-2], pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
             pa.array([k.decode("utf-8", "replace") for k in kept], pa.string()), pa.array(checks, check)],
            [*batch.schema.names[:-2], *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(cut, batches)
    return run


def verify(checks: DataFrame) -> None:
    """Fail unless the words of every span are those at its source coordinates; rows (of1, of2, at, words, digest)."""
    bad = checks.groupBy("of1", "of2", "at", "words").agg(F.min("digest").alias("least"), F.max("digest").alias("most"))
    if bad.where("least <> most").limit(1).count():
        raise RuntimeError("two different passages share a 128-bit digest")


def _answered(docs: DataFrame, text: Column, window: int, kmer: int) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with n_words, n_removed and kept under fresh names, which are returned, and checks for ``verify``."""
    if not 0 < kmer <= window:
        raise ValueError("a k-mer has to fit into a window")
    prepare(docs.sparkSession)
    rows = keyed(text, docs)
    spans = materialize(repeated_spans(rows, window, kmer), "repeated-spans")
    mine = spans.withColumn("goes", F.lit(True))
    source = spans.select(F.col("of1").alias("k1"), F.col("of2").alias("k2"), F.col("at").alias("start"),
                          (F.col("at") + F.col("end") - F.col("start")).alias("end"), "of1", "of2", "at", F.lit(False).alias("goes"))
    asks = mine.unionByName(source.distinct()).groupBy(*KEY).agg(F.collect_set(F.struct(*SPAN)).alias("spans"))
    asks = materialize(asks, "spans-of-texts")
    # Texts with over a thousandth of all rows are looked up by broadcast: copies, whose spans are few.
    counts = rows.groupBy(*KEY).agg(F.count(F.lit(1)).alias("rows"))
    total = docs.select(F.lit(1)).count()
    many = counts.where(F.col("rows") > int(total * HOT)).join(asks, KEY, "left").where(F.coalesce(F.size("spans") <= FEW_SPANS, F.lit(True)))
    many = materialize(many.select(*KEY, "spans"), "frequent-texts")
    names = {c: fresh(docs, c) for c in ("of_k1", "of_k2", "of_text", "spans", *DONE, *KEY)}
    named = lambda df: df.select(*[F.col(c).alias(names[c]) for c in (*KEY, "spans")])
    many, asks = F.broadcast(named(many)), named(asks)
    first, second = keys_of(text)
    marked = docs.withColumn(names["of_k1"], first).withColumn(names["of_k2"], second).withColumn(names["of_text"], text)
    same = (F.col(names["of_k1"]) == F.col(names["k1"])) & (F.col(names["of_k2"]) == F.col(names["k2"]))
    rest = marked.join(many, same, "left_anti").join(asks, same, "left")
    both = marked.join(many, same).unionByName(rest).select(*docs.columns, names["of_text"], names["spans"])
    kinds = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), *(f"{names[c]} {t}" for c, t in DONE.items())])
    return both.mapInArrow(_done([names[c] for c in DONE]), kinds), names


def _verified(answered: DataFrame, names: dict[str, str], name: str) -> DataFrame:
    answered = materialize(answered, name)
    verify(answered.select(F.explode(names["checks"]).alias("check")).select("check.*"))
    return answered


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                kmer: int = KMER) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the kept words joined by one space) for every row.

    Words are `[^\\x20\\x09-\\x0D]+`, unchanged. A word goes if a window of ``window`` consecutive words of its
    document covers it whose words also begin anywhere else, in the same document or another; windows are judged on
    the input. Null and empty texts have no words; texts shorter than a window lose nothing; of repeated rows, with
    equal or null ids too, all long enough lose their words. An empty table gives no rows; other columns are ignored.
    A text is cut into words as a whole, in one task; spans of it are merged as far as paths go.
    """
    rows = texts(docs, id_col, text_col)
    answered, names = _answered(rows, F.col("text"), window, kmer)
    return _verified(answered.select("doc_id", "n_words", "n_removed", "kept", "checks"), names, "cut-texts").drop("checks")


def substring_report(docs: DataFrame, window: int = WINDOW, kmer: int = KMER) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row, as ``cut_repeats`` defines them."""
    answered, names = _answered(texts(docs), F.col("text"), window, kmer)
    answered = answered.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"), "checks")
    return _verified(answered, names, "cut-digests").drop("checks")


def drop_repeats(docs: DataFrame, window: int = WINDOW, kmer: int = KMER) -> DataFrame:
    """``docs`` with the text of affected rows replaced by their kept words, joined by one space, and, if there is a
    column n_chars, that with it; other rows and columns, whatever their names, stay as they are.

    No row is dropped: a text of nothing but repeats becomes empty. Repeated rows, null ids and null texts are as in
    ``cut_repeats``.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    answered, names = _answered(docs, text, window, kmer)
    cut, kept = F.col(names["n_removed"]) > 0, F.col(names["kept"])
    answered = answered.withColumn("text", F.when(cut, kept).otherwise(F.col("text")))
    if (name := next((c for c in docs.columns if c.lower() == "n_chars"), None)) is not None:
        kind = docs.schema[name].dataType
        answered = answered.withColumn(name, F.when(cut, F.length(kept).cast(kind)).otherwise(F.col(name)))
    return _verified(answered.select(*docs.columns, names["checks"]), names, "cut-documents").drop(names["checks"])
