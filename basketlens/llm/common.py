"""What the operators of this package share: scans, texts as flat byte arrays, and word hashes."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.session import materialize, ship_package

#: Bytes that separate words: space and \x09-\x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package, and bound what they get at once: long texts make small batches."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    spark.conf.set("spark.sql.execution.arrow.useLargeVarTypes", "false")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) alone, whatever else the frame carries; a null text counts as empty."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def fresh(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` doesn't have, in any spelling."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_key(text: Column) -> Column:
    """SHA-256 of a text: what tells texts apart, whatever their ids."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def rows_of(docs: DataFrame, kept: DataFrame, digest: Column, id_col: str = "doc_id", *more: str) -> DataFrame:
    """``docs`` with one row for each row of ``kept``: kept_id, kept_digest, times (how many rows of ``docs`` have both).

    Ids compare null-safe. Only keys that several rows share go through an aggregate, which collapses them inside each
    input partition first; of such rows any one stays. Columns stay as they are; those of ``more`` follow from ``kept``.
    """
    key, name = fresh(docs, "of_id"), fresh(docs, "of_digest")
    kept = materialize(kept.select(F.col("kept_id").alias(key + "k"), F.col("kept_digest").alias(name + "k"), "times", *more), "kept-rows")
    marked = docs.withColumn(key, F.col(id_col).cast("long")).withColumn(name, digest)

    def found(some: DataFrame) -> DataFrame:
        on = marked[key].eqNullSafe(some[key + "k"]) & (marked[name] == some[name + "k"])
        if not more:
            return marked.join(some, on, "left_semi")
        return marked.join(some.drop("times"), on).drop(key + "k", name + "k")
    repeated = found(kept.where("times > 1")).dropDuplicates([key, name])
    return found(kept.where("times = 1")).unionByName(repeated).drop(key, name)


#: A key with more than this share of all rows is looked up by broadcast; at most 1 / HOT keys can be so frequent.
HOT = 1 / 1000


def lookup(rows: DataFrame, table: DataFrame, key: str | list[str], times: str) -> DataFrame:
    """``rows`` with the columns of ``table``, which has one row for a key and, in ``times``, about its count in ``rows``;
    rows of other keys are left out.

    Keys with over a thousandth of all counts, of which there are fewer than a thousand, are looked up by broadcast, the
    others by a join: no task gets all rows of a frequent key. Keys are not null.
    """
    key = [key] if isinstance(key, str) else key
    table = materialize(table, "lookup")
    total = table.agg(F.sum(times)).head()[0] or 0
    frequent = F.broadcast(table.where(F.col(times) > int(total * HOT)))
    rest = rows.join(frequent.select(key), key, "left_anti").join(table.where(F.col(times) <= int(total * HOT)), key)
    return rows.join(frequent, key).unionByName(rest)


def count_blocks(rows: int, rows_per_block: int) -> int:
    return max(1, math.ceil(rows / rows_per_block))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column as one byte array and its offsets, without copying; nulls are empty."""
    if column.null_count:
        column = pa.compute.fill_null(column, "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if large else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Cut rows into runs of about ``most`` bytes; a longer text is a run of its own."""
    first = 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(max(last, first + 1), len(offsets) - 1)
        yield first, last
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word `[^\\x20\\x09-\\x0D]+`, and the first word of each text (one more entry than texts)."""
    inside = ~SPACE[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < len(data)]
    start[firsts] |= inside[firsts]
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    lasts = offsets[1:][offsets[1:] > 0] - 1
    end[lasts] |= inside[lasts]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def texts_of(column: pa.Array) -> list[bytes]:
    """A string column as bytes; nulls are empty."""
    return [t or b"" for t in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()]


def mix(x: np.ndarray) -> np.ndarray:
    """The finishing steps of a 64-bit hash."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(33))


_ODD = np.uint64(0x9E3779B97F4A7C15)
_LANES = ((np.uint64(0xA0761D6478BD642F), _ODD), (np.uint64(0xE7037ED1A0B428DB), np.uint64(0xD1342543DE82EF95)))
#: Bytes of a word above which it is hashed alone.
LONG_WORD = 256


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """128 bits for each word data[start:end], as two columns: eight bytes at a time are mixed in, so that no order of
    like bytes sums to another; a long word has a BLAKE2 digest."""
    length = ends - starts
    eight = np.ndarray(len(data), "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
    lanes = [mix(length.astype(np.uint64) + key) for key, _ in _LANES]
    at, left = np.flatnonzero(length <= LONG_WORD), length
    begin, left = starts[at], length[at]
    while len(at):
        chunk = eight[begin]
        short = left < 8
        chunk[short] &= (np.uint64(1) << (left[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
        for lane, (key, odd) in zip(lanes, _LANES):
            lane[at] = mix((lane[at] ^ key) * odd + chunk)
        more = left > 8
        at, begin, left = at[more], begin[more] + 8, left[more] - 8
    out = np.stack(lanes, axis=1)
    for i in np.flatnonzero(length > LONG_WORD):
        out[i] = np.frombuffer(hashlib.blake2b(data[starts[i]:ends[i]].tobytes(), digest_size=16).digest(), np.uint64)
    return out


def run_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """64-bit hash of each run of ``width`` hashes: halves are mixed pairwise, so no run of any pattern sums to another."""
    n = len(hashes) - width + 1
    if n <= 0 or not width:
        return np.zeros(max(n, 0), np.uint64)
    out, have, level, size = None, 0, hashes, 1
    while True:
        if width & size:
            out = level[:n] if out is None else mix(out * _ODD + level[have:have + n])
            have += size
        if have == width:
            return out
        level = mix(level[:-size] * _ODD + level[size:])
        size *= 2
