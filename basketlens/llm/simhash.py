"""Near duplicates by 64-bit fingerprints of word shingles, found through the anchor points of a covering code.

The anchors are the codewords of the Hamming code on the first 63 bits, with the last bit free: every 64-bit value lies
within one bit of an anchor (covering radius 1), and the syndrome of a fingerprint names the flips that lead to anchors.
Two fingerprints that differ in at most t bits have a value half-way between them, at most ceil(t / 2) bits from
either, so the anchor next to that value lies within 1 + ceil(t / 2) bits of both. Each distinct fingerprint is
therefore copied to every anchor within the covering radius plus half the threshold on its own side (33 anchors for
t = 2; the whole threshold on one side would take 684 and find the same links), and fingerprints are compared per anchor.

All fingerprints at one anchor lie within that small ball around it (at most 2,081 distinct ones for t = 2), so no
anchor grows with the data: copies of one text share a fingerprint, and only distinct fingerprints are posted.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import LOWER, lookup, prepare, texts
from basketlens.llm.graph import components
from basketlens.session import materialize

#: Seed of the hash, words of a shingle, bits in which linked fingerprints may differ.
SEED, WIDTH, THRESHOLD = 42, 3, 2
#: Bytes of a text that are cut into words at a time.
PIECE = 1 << 20

_LOWER = LOWER.tobytes()
_BLANK = b" \t\n\v\f\r"


def _runs(text: bytes, most: int) -> Iterator[list[bytes]]:
    """Lower-cased words of a text, in runs from about ``most`` bytes each."""
    begin = 0
    while begin < len(text):
        end = min(begin + most, len(text))
        while end < len(text) and text[end] not in _BLANK:
            end += 1
        yield text[begin:end].translate(_LOWER).split()
        begin = end


def bit_counts(words: list[bytes], width: int) -> tuple[np.ndarray, int]:
    """How many of the hashes of all runs of ``width`` words have each bit, and how many hashes there are."""
    joined = b" ".join(words)
    length = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(length + 1) - 1
    starts = (ends - length)[:len(words) - width + 1].tolist()
    hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1:].tolist())], np.uint64)
    return np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64), len(hashes)


def fingerprint(text: bytes, width: int = WIDTH, most: int = PIECE) -> int:
    """Bit i is set if it is in over half of the hashes; a text without words has fingerprint 0. Signed."""
    counts, n, before = np.zeros(64, np.int64), 0, []
    for words in _runs(text, most):
        words = before + words
        if len(words) >= width:
            more, m = bit_counts(words, width)
            counts, n = counts + more, n + m
        before = words[max(0, len(words) - width + 1):]
    if not n and before:
        counts, n = bit_counts(before, len(before))
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.int64)[0])


def _fingerprints(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_buffer().to_pybytes(), width) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], ["doc_id", "fingerprint"])
    return run


def syndromes(values: np.ndarray) -> np.ndarray:
    """Of each value the sum, without carry, of the places 1 to 63 of its set bits; 0 for an anchor."""
    out = np.zeros(len(values), np.uint64)
    for k in range(6):  # bit k of the sum is the parity of the places that have bit k
        places = np.uint64(sum(1 << (p - 1) for p in range(1, 64) if p >> k & 1))
        out |= (np.bitwise_count(values & places) & 1).astype(np.uint64) << np.uint64(k)
    return out.astype(np.int64)


@lru_cache
def flips(reach: int) -> tuple[np.ndarray, ...]:
    """By syndrome, all patterns of at most ``reach`` flipped bits that lead to an anchor."""
    bits = np.uint64(1) << np.arange(64, dtype=np.uint64)
    patterns = np.concatenate([np.zeros(1, np.uint64), *(
        np.bitwise_or.reduce(bits[np.array(list(combinations(range(64), n)))], axis=1) for n in range(1, reach + 1))])
    of = syndromes(patterns)
    return tuple(patterns[of == s] for s in range(64))


def anchors(values: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, value) for every anchor within ``reach`` bits of each value."""
    of = syndromes(values)
    out = [((values[of == s][:, None] ^ flips(reach)[s]).ravel(), np.repeat(values[of == s], len(flips(reach)[s])))
           for s in np.unique(of)]
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.uint64),) * 2


def _posts(reach: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anchor, value = anchors(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), reach)
            yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(value.view(np.int64))],
                                             ["anchor", "fingerprint"])
    return run


def spanning(values: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of values that differ in at most ``threshold`` bits: as few links as connect them."""
    label, out = np.arange(len(values)), []
    for i in range(len(values) - 1):
        later = i + 1 + np.flatnonzero(label[i + 1:] != label[i])
        for j in later[np.bitwise_count(values[later] ^ values[i]) <= threshold]:
            if label[j] != label[i]:
                out.append((i, int(j)))
                label[label == label[j]] = label[i]
    return out


def _links(anchor: np.ndarray, value: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within each anchor; rows come sorted by anchor."""
    begin = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    size = np.diff(np.append(begin, len(anchor)))
    two = begin[size == 2]
    two = two[np.bitwise_count(value[two] ^ value[two + 1]) <= threshold]
    out = [(value[two], value[two + 1])]
    for a, m in zip(begin[size > 2], size[size > 2]):
        if found := spanning(value[a:a + m], threshold):
            i, j = np.array(found).T
            out.append((value[a + i], value[a + j]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _compare(threshold: int):
    """Links (a, b) of the anchors of a partition that comes sorted by anchor; only an unended anchor is carried on."""
    def batch_of(anchor, value):
        a, b = _links(anchor, value, threshold)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, value = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            anchor = np.concatenate([anchor, batch.column(0).to_numpy(zero_copy_only=False)])
            value = np.concatenate([value, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
            if len(anchor):
                cut = int(np.searchsorted(anchor, anchor[-1]))
                if cut:
                    yield batch_of(anchor[:cut], value[:cut])
                anchor, value = anchor[cut:], value[cut:]
        if len(anchor):
            yield batch_of(anchor, value)
    return run


def linked_fingerprints(distinct: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(node, root): fingerprints that link with another one, and the least (as a signed number) they reach.

    ``distinct`` has one row per fingerprint, as bigint. Fingerprints link at ``threshold`` or fewer differing bits.
    """
    if not 0 <= threshold <= 4:
        raise ValueError("the threshold has to lie between 0 and 4")
    reach = 1 + -(-threshold // 2)
    posts = distinct.select("fingerprint").mapInArrow(_posts(reach), "anchor bigint, fingerprint bigint")
    posts = posts.repartition("anchor").sortWithinPartitions("anchor", "fingerprint")
    return components(posts.mapInArrow(_compare(threshold), "a bigint, b bigint"), "fingerprints")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                    threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row.

    A-Z are lower-cased; words are `[^\\x20\\x09-\\x0D]+` of the whole text, shingles ``width`` consecutive words, repeats
    included, joined by one space; a text of fewer words is one shingle. A bit of the fingerprint is 1 if it is in over
    half of the shingles' XXH64 (seed 42). A text without words, and a null, has fingerprint zero and links like any
    other. ``component_id`` is the smallest id reachable by links of ``threshold`` or fewer differing bits, the row's own
    included; null ids lose against any id, and a component of null ids alone has a null one. Repeated rows give
    repeated results; an empty table gives none; other columns are ignored, whatever their names. A text is cut into
    words about a megabyte at a time, so beside the text itself memory doesn't grow with its length.
    """
    prepare(docs.sparkSession)
    rows = materialize(texts(docs, id_col, text_col).mapInArrow(_fingerprints(width), "doc_id bigint, fingerprint bigint"),
                       "fingerprints")
    classes = materialize(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("own"), F.count(F.lit(1)).alias("times")),
                          "fingerprint-classes")
    found = materialize(linked_fingerprints(classes, threshold), "linked-fingerprints")
    named = classes.join(found.withColumnRenamed("node", "fingerprint"), "fingerprint")
    least = named.groupBy("root").agg(F.min("own").alias("least"))
    reached = named.join(least, "root").select("fingerprint", "least")
    classes = classes.join(reached, "fingerprint", "left").select(
        "fingerprint", "times", F.coalesce("least", "own").alias("component_id"))
    return lookup(rows, classes, "fingerprint", "times").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
