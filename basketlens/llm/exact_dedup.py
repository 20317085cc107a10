"""Exact duplicates by Grace hashing.

Records are dealt to buckets by a hash of their content: first over Spark's partitions, then, where a bucket does
not fit its table, over spill files of the task, again and again by further bits. A bucket that fits is resolved
in an open-addressing table that compares complete content, so equal hashes alone never merge two texts.

Rows are collapsed inside each input partition before anything is shuffled, so a content that a third of all rows
share reaches its bucket once per input partition.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import lookup, prepare, rows_of, texts

#: Spill files per level, by four more bits of the digest.
FAN_OUT_BITS = 4

Record = tuple[bytes, bytes, int, int | None]  # digest, content, rows, largest id


class OpenTable:
    """Open addressing with linear probing; an entry matches when digest and complete content are equal."""

    def __init__(self, most_bytes: int):
        self.most_bytes, self.used = most_bytes, 0
        self.slots = np.full(1024, -1, np.int64)
        self.records: list[list] = []

    def find(self, digest: bytes, content: bytes) -> tuple[int, int]:
        """(slot, entry); the entry is -1 where the content is not in the table."""
        mask = len(self.slots) - 1
        slot = int.from_bytes(digest[-8:], "little") & mask
        while (entry := int(self.slots[slot])) >= 0:
            record = self.records[entry]
            if record[0] == digest and record[1] == content:
                return slot, entry
            slot = (slot + 1) & mask
        return slot, -1

    def add(self, record: Record) -> bool:
        """Merge or insert; False where the content is new and the table is full."""
        digest, content, rows, largest = record
        slot, entry = self.find(digest, content)
        if entry >= 0:
            held = self.records[entry]
            held[2] += rows
            if held[3] is None or largest is not None and largest > held[3]:
                held[3] = largest
            return True
        if self.records and self.used + len(content) > self.most_bytes:
            return False
        self.slots[slot] = len(self.records)
        self.records.append([digest, content, rows, largest])
        self.used += len(content) + 200
        if 2 * len(self.records) > len(self.slots):
            self.grow()
        return True

    def grow(self) -> None:
        self.slots = np.full(2 * len(self.slots), -1, np.int64)
        mask = len(self.slots) - 1
        for entry, record in enumerate(self.records):
            slot = int.from_bytes(record[0][-8:], "little") & mask
            while self.slots[slot] >= 0:
                slot = (slot + 1) & mask
            self.slots[slot] = entry


def grace(records: Iterable[Record], most_bytes: int, folder: str, level: int = 0) -> Iterator[list]:
    """Distinct contents with rows and largest id; what does not fit the table goes to spill files of this task."""
    held = OpenTable(most_bytes)
    files: dict[int, object] = {}
    try:
        for record in records:
            if not held.add(record):
                bit = level * FAN_OUT_BITS % 192
                bucket = int.from_bytes(record[0][:24], "big") >> (192 - FAN_OUT_BITS - bit) & ((1 << FAN_OUT_BITS) - 1)
                if bucket not in files:
                    files[bucket] = open(os.path.join(folder, f"{level}-{bucket}"), "wb")
                pickle.dump(record, files[bucket], protocol=5)
        yield from held.records
    finally:
        for file in files.values():
            file.close()
    del held
    for bucket in sorted(files):
        path = os.path.join(folder, f"{level}-{bucket}")
        with tempfile.TemporaryDirectory(dir=folder) as below:
            yield from grace(_spilled(path), most_bytes, below, level + 1)
        os.unlink(path)


def _spilled(path: str) -> Iterator[Record]:
    with open(path, "rb") as file:
        while True:
            try:
                yield pickle.load(file)
            except EOFError:
                return


def normalised(text: str) -> bytes:
    """UTF-8 of the text with A-Z, and nothing else, in lower case."""
    return text.encode("utf-8", "surrogatepass").lower()


RECORDS = pa.schema([("digest", pa.binary()), ("content", pa.binary()), ("n", pa.int64()), ("largest", pa.int64())])


def _batches(records: Iterable[list], columns: list[int], schema: pa.Schema, most: int = 4 << 20
             ) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for record in records:
        rows.append([record[i] for i in columns])
        size += len(record[1])
        if size > most or len(rows) >= 20_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
            rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _collapse(most_bytes: int):
    """Collapse the rows of one input partition; a full table is passed on and begun anew."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = OpenTable(most_bytes)
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                content = normalised(text)
                record = (hashlib.sha256(content).digest(), content, 1, key)
                if not held.add(record):
                    yield from _batches(held.records, [0, 1, 2, 3], RECORDS)
                    held = OpenTable(most_bytes)
                    held.add(record)
        yield from _batches(held.records, [0, 1, 2, 3], RECORDS)
    return run


GROUPS = pa.schema([("digest", pa.binary()), ("group_size", pa.int64()), ("keep_id", pa.int64())])


def _resolve(most_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryDirectory(prefix="grace-") as folder:
            records = (record for batch in batches for record in zip(*(c.to_pylist() for c in batch.columns)))
            yield from _batches(grace(records, most_bytes, folder), [0, 2, 3], GROUPS)
    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [hashlib.sha256(normalised(t)).digest() for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["doc_id", "digest"])


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 table_bytes: int = 64 << 20) -> DataFrame:
    """One row per input row: doc_id, digest (SHA-256 of the normalised text), group_size, keep_id.

    Texts are equal when identical after lower-casing A-Z; a null text is an empty one. ``keep_id`` is the largest
    id of the group; null ids lose against any id, and a group of null ids alone has a null ``keep_id``. Repeated
    rows count each. An empty table gives no rows; other columns are ignored, whatever their names. ``table_bytes``
    bounds the table of a task; beyond it records go to spill files, never away.

    Two texts of one digest would make the answer ambiguous and end the job with an error.
    """
    prepare(docs.sparkSession)
    rows = texts(docs, id_col, text_col)
    records = rows.mapInArrow(_collapse(table_bytes // 2), "digest binary, content binary, n bigint, largest bigint")
    groups = records.repartition(F.col("digest")).mapInArrow(
        _resolve(table_bytes), "digest binary, group_size bigint, keep_id bigint")
    members = rows.mapInArrow(_digests, "doc_id bigint, digest binary")
    # A doubled digest would be two texts with one SHA-256.
    checked = groups.groupBy("digest").agg(
        F.when(F.count(F.lit(1)) == 1, F.max("group_size"))
        .otherwise(F.raise_error(F.lit("two texts with one SHA-256"))).cast("long").alias("group_size"),
        F.max("keep_id").alias("keep_id"))
    return lookup(members, checked, "digest", "group_size").select("doc_id", "digest", "group_size", "keep_id")


def exact_dedup_report(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``."""
    return exact_groups(docs).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def _digest_of(texts: pa.Array) -> pa.Array:
    return pa.array([hashlib.sha256(normalised(t)).digest() for t in texts.to_pylist()], pa.binary())


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row per distinct text: the one with the largest id. Columns stay as they are.

    Of rows that share both that id and the text any one stays. An id with several texts is decided for each text by
    itself. Of a group of null ids alone one row stays; next to any id a null id loses. Null texts count as empty ones
    but stay null; columns of any name are kept; an empty table gives no rows.
    """
    kept = exact_groups(docs, id_col, text_col).where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    kept = kept.groupBy(F.col("doc_id").alias("kept_id"), F.col("digest").alias("kept_digest")).agg(
        F.count(F.lit(1)).alias("times"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return rows_of(docs, kept, F.arrow_udf(_digest_of, "binary")(text), id_col)
