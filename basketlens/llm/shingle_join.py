"""Documents whose sets of word shingles have a Jaccard similarity of at least a given per cent, and their components.

Equal sets are one class. Sizes are cut into bands; in a band of sizes a set is cut, by a hash of its shingles,
into more parts than two similar sets can differ in shingles, so two similar sets agree in a whole part. Classes
are posted under their parts, many posts packed into one row; a post that no other class shares ends there. The
others meet in tiles: sorted by size, compared by hashed bitmaps whose differing bits bound the overlap from above.
What passes is joined into candidate components, whose sorted shingle arrays travel once and are intersected
exactly, again tile by tile.

Only a spanning forest of links, and for each class the number of its links, ever leave a task. Where the numbers are
not asked for, two classes in one tile that are already connected are not compared again, so a group of near copies
costs about one comparison for each member.

Shingles are told apart by 128 bits mixed from 128 bits for each word, sets by a 128-bit BLAKE2 digest of their
shingles; the first 64 bits of either only seek candidates, so that what collides there is compared in vain.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import LOWER, flat, lookup, mix, pieces, prepare, rows_of, text_key, texts, word_hashes, word_spans
from basketlens.llm.graph import components
from basketlens.session import materialize

#: Members of a block; a group with more is cut into blocks, and each pair of blocks is a tile.
BLOCK = 2048
#: Bits of a bitmap, from the smallest to the largest sets.
LEAST_BITS, MOST_BITS = 64, 4096
#: Posts that a task packs at a time, and posts of one key among them from which on they go out as they are.
PACKED_POSTS, FREQUENT = 2_000_000, 64
#: Posts of a packet, about.
PACKET_POSTS = 4_000_000
#: Ways of cutting a set into parts that are tried in turn, where too many parts come out empty.
LEVELS = 8


@dataclass(frozen=True)
class Band:
    number: int
    low: int
    high: int  # exclusive
    parts: int
    spare: int  # parts that may be empty
    bits: int


@lru_cache
def bands(percent: int, up_to: int) -> tuple[Band, ...]:
    """Bands of sizes. Sets of sizes a <= b can only be similar if they differ in at most
    (a + b) * (100 - percent) / (100 + percent) shingles and b <= 100 * a / percent."""
    most = lambda a: (a + 100 * a // percent) * (100 - percent) // (100 + percent)
    low, out = 1, []
    while not most(low):
        low += 1  # smaller sets are similar only if equal
    step = max(1.5, 110 / percent)
    while low <= up_to:
        high = max(low + 1, math.ceil(low * step))
        differ, spare = most(high - 1), 1
        while True:
            parts = differ + 1 + spare
            empty = parts * math.exp(-low / parts)
            if spare >= empty + 4 * math.sqrt(empty) + 1 or spare >= max(1, low // 2 - differ - 1):
                break
            spare += 1
        bits = min(MOST_BITS, max(LEAST_BITS, 1 << (high - 1).bit_length()))
        out.append(Band(len(out), low, high, parts, spare, bits))
        low = high
    return tuple(out)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each text (128 bits in two columns), one after the other, and where each text's begin."""
    data = LOWER[data]
    starts, ends, first = word_spans(data, offsets)
    hashes, counts = word_hashes(data, starts, ends), np.diff(first)
    text_of = np.repeat(np.arange(len(counts)), counts)
    size = np.minimum(counts, width)[text_of]  # of the shingle that begins at a word
    at = np.flatnonzero(np.arange(len(starts)) - first[:-1][text_of] <= counts[text_of] - size)
    value = np.repeat(size[at].astype(np.uint64)[:, None], 2, axis=1)
    for i in range(width):
        inside = (i < size[at])[:, None]
        word = hashes[np.minimum(at + i, max(0, len(starts) - 1))]
        value = mix(value * np.uint64(0x9E3779B97F4A7C15) + np.where(inside, word, np.uint64(i)))
    text_of = text_of[at]
    order = np.lexsort((value[:, 0], text_of))
    if _collides(value[order], text_of[order]):
        order = np.lexsort((value[:, 1], value[:, 0], text_of))
    value, text_of = value[order], text_of[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]).any(axis=1) | (text_of[1:] != text_of[:-1])
    value, text_of = value[new], text_of[new]
    return value, np.searchsorted(text_of, np.arange(len(counts) + 1))


def _collides(value: np.ndarray, group: np.ndarray) -> bool:
    """Whether neighbours of a group agree in their first 64 bits only."""
    same, first = value[1:] == value[:-1], group[1:] == group[:-1]
    return bool((same[:, 0] & ~same[:, 1] & first).any())


def bitmap(values: np.ndarray, bits: int) -> bytes:
    """Bit i tells whether an odd number of shingles hash to i: sets differ in at least as many shingles as bits."""
    odd = np.bincount((values & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def posts(values: np.ndarray, first: np.ndarray, percent: int) -> list[np.ndarray]:
    """Keys under which each set is posted: its parts in its own band, and in the one below if a similar set may be there."""
    sizes = np.diff(first)
    known = bands(percent, int(sizes.max(initial=0)))
    if not known:
        return [np.zeros(0, np.int64)] * len(sizes)
    own = np.searchsorted([b.low for b in known], sizes, side="right") - 1
    out: list[list[np.ndarray]] = [[] for _ in sizes]
    todo = [(i, int(own[i])) for i in range(len(sizes)) if own[i] >= 0]
    todo += [(i, b - 1) for i, b in todo if b > 0 and -(-percent * int(sizes[i]) // 100) < known[b].low]
    for level in range(LEVELS):
        if not todo:
            break
        text, band = (np.array(x) for x in zip(*todo))
        parts = np.array([b.parts for b in known])[band]
        base = np.concatenate([[0], np.cumsum(parts)])
        length = sizes[text]
        at = np.repeat(first[:-1][text] - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(length.sum())
        shingle = mix(values[at] ^ np.uint64((0xD1342543DE82EF95 * (level + 1)) % 2**64))
        place = np.repeat(base[:-1], length) + (shingle % np.repeat(parts, length).astype(np.uint64)).astype(np.int64)
        order = np.argsort(place, kind="stable")
        place, shingle = place[order], mix(shingle[order] + np.uint64(1))
        new = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        sums = np.add.reduceat(shingle, new)
        place = place[new]
        owner = np.searchsorted(base, place, side="right") - 1
        name = (band[owner].astype(np.uint64) << np.uint64(40)) + (np.uint64(level) << np.uint64(32))
        keys = mix(mix(sums) + mix(name + (place - base[owner]).astype(np.uint64) + np.uint64(1))).view(np.int64)
        ends = np.searchsorted(owner, np.arange(len(todo) + 1))
        again = []
        for j, (i, b) in enumerate(todo):
            out[i].append(keys[ends[j]:ends[j + 1]])
            if parts[j] - (ends[j + 1] - ends[j]) > known[b].spare:
                again.append((i, b))  # too many empty parts to rely on the others: cut anew by another hash
        todo = again
    for i, b in todo:  # those that every hash cuts badly meet under one key of the band
        out[i].append(mix(np.array([(b << 40) + (LEVELS << 32)], np.uint64)).view(np.int64))
    return [np.concatenate(keys) if keys else np.zeros(0, np.int64) for keys in out]


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple]:
    """(batch, first row, sets) of runs of texts; texts are the second column."""
    for batch in batches:
        data, offsets = flat(batch.column(1))
        for a, b in pieces(offsets):
            values, first = shingle_sets(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], width)
            yield batch, a, [values[i:j] for i, j in zip(first, first[1:])]


def _digest(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def _name(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def _rows(width: int, percent: int):
    """For each text its set's digest, size and bitmap, and about how many posts it will have; sets that can only be
    similar to equal ones have no bitmap."""
    def run(batches):
        for batch, a, sets in _sets(batches, width):
            known = bands(percent, max(map(len, sets), default=0))
            band = [next((b for b in known if b.low <= len(s) < b.high), None) for s in sets]
            bits = [b and bitmap(s[:, 0], b.bits) for s, b in zip(sets, band)]
            digests = [_digest(s) for s in sets]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(a, len(sets)), pa.array(digests, pa.binary()),
                pa.array([len(s) for s in sets], pa.int64()), pa.array(bits, pa.binary()),
                pa.array([_name(d) for d in digests], pa.int64()), batch.column(2).slice(a, len(sets)),
                pa.array([b and b.parts for b in band], pa.int64())],
                ["doc_id", "digest", "n", "bits", "id", "text_digest", "posts"])
    return run


PACKETS = pa.schema([("packet", pa.int32()), ("keys", pa.binary()), ("ids", pa.binary()), ("counts", pa.binary()),
                     ("frequent", pa.bool_())])


def _pack(keys: np.ndarray, ids: np.ndarray, packets: int, frequent: bool) -> Iterator[tuple]:
    """One row for each packet: half of each key (the packet is the other half), grouped by set; names and counts of sets."""
    number = (keys & np.uint64(0xFFFFFFFF)) % np.uint64(packets)
    order = np.lexsort((ids, number))
    number, keys, ids = number[order], (keys[order] >> np.uint64(32)).astype(np.uint32), ids[order]
    cuts = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1], [True]])) if len(keys) else []
    for a, b in zip(cuts, cuts[1:]):
        name, counts = np.unique(ids[a:b], return_counts=True)
        yield int(number[a]), keys[a:b].tobytes(), name.tobytes(), counts.astype(np.uint32).tobytes(), frequent


def _unpack(keys: bytes, ids: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(keys, np.uint32), np.repeat(np.frombuffer(ids, np.int64), np.frombuffer(counts, np.uint32))


def _packets(width: int, percent: int, packets: int, most: int, often: int):
    """Posts of a partition's sets, each set once, in packets. Keys that are frequent here are shared for sure: all
    but a few of their posts skip the packet, so no packet grows with a group of near copies."""
    def packed(held: list) -> pa.RecordBatch:
        keys, ids = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((ids, keys))
        keys, ids = keys[order], ids[order]
        new = np.concatenate([[True], keys[1:] != keys[:-1]])
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(keys)))
        beyond = np.repeat(size >= often, size) & (np.arange(len(keys)) - np.repeat(begin, size) >= 2)
        rows = [*_pack(keys[~beyond], ids[~beyond], packets, False), *_pack(keys[beyond], ids[beyond], packets, True)]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), PACKETS)], schema=PACKETS)

    def run(batches):
        held, total, seen = [], 0, set()
        for _, _, sets in _sets(batches, width):
            first = np.cumsum([0, *map(len, sets)])
            values = np.concatenate([s[:, 0] for s in sets]) if sets else np.zeros(0, np.uint64)
            for digest, keys in zip(map(_digest, sets), posts(values, first, percent)):
                if len(keys) and digest not in seen:
                    seen.add(digest)
                    name = _name(digest)
                    held.append((keys.view(np.uint64), np.full(len(keys), name, np.int64)))
                    total += len(keys)
            if total >= most:
                yield packed(held)
                held, total = [], 0
        if held:
            yield packed(held)
    return run


def _shared(batches):
    """(grp, id) of the posts of one packet whose key at least two sets have; rows come sorted by packet, rare ones first."""
    schema = pa.schema([("grp", pa.int64()), ("id", pa.int64())])

    def out(packet, keys, ids):
        return pa.RecordBatch.from_arrays([pa.array((np.int64(packet) << np.int64(32)) + keys.astype(np.int64)),
                                           pa.array(ids)], schema=schema)

    def met(packet, held):
        keys, ids = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((ids, keys))
        keys, ids = keys[order], ids[order]
        begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        end = np.append(begin[1:], len(keys))
        several = np.repeat(ids[begin] != ids[end - 1], end - begin)
        return out(packet, keys[several], ids[several])

    at, held = None, []
    for batch in batches:
        for packet, keys, ids, counts, frequent in zip(*(c.to_pylist() for c in batch.columns)):
            if packet != at and held:
                yield met(at, held)
                held = []
            at = packet
            if frequent:
                yield out(packet, *_unpack(keys, ids, counts))
            else:
                held.append(_unpack(keys, ids, counts))
    if held:
        yield met(at, held)


def _arrays(width: int):
    """Sorted shingles of candidate classes, from the text of one of their rows."""
    def run(batches):
        for batch, a, sets in _sets(batches, width):
            more = [batch.column(i).slice(a, len(sets)) for i in range(2, batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*more, pa.array([s.tobytes() for s in sets], pa.binary())],
                                             [*batch.schema.names[2:], "shingles"])
    return run


def _fold(bits: list[bytes]) -> np.ndarray:
    """Bitmaps as rows of words; wider ones are folded onto the narrowest."""
    width = min(map(len, bits))
    return np.stack([np.bitwise_xor.reduce(np.frombuffer(b, np.uint64).reshape(-1, width // 8), axis=0) for b in bits])


def connect(sizes: np.ndarray, blocks: np.ndarray | None, percent: int, similar: Callable[[int, np.ndarray], np.ndarray],
            weights: np.ndarray | None = None) -> tuple[list[tuple[int, int]], np.ndarray]:
    """A spanning forest of the similar pairs of one tile, and each row's sum of the ``weights`` of its partners.

    Rows come sorted by size. With ``blocks``, only pairs between different blocks are meant. Without weights, rows that are
    already connected are not compared again.
    """
    label, edges, sums = np.arange(len(sizes)), [], np.zeros(len(sizes), np.int64)
    reach = np.searchsorted(sizes, 100 * sizes // percent, side="right")
    for i in range(len(sizes) - 1):
        later = np.arange(i + 1, reach[i])
        if blocks is not None:
            later = later[blocks[later] != blocks[i]]
        if weights is None:
            later = later[label[later] != label[i]]
        if not len(later):
            continue
        found = similar(i, later)
        if weights is not None:
            sums[i] += weights[found].sum()
            sums[found] += weights[i]
        for other, at in zip(*np.unique(label[found], return_index=True)):
            if other != label[i]:
                edges.append((i, int(found[at])))
                label[label == other] = label[i]
    return edges, sums


def _by_bitmap(sizes: np.ndarray, bits: np.ndarray, percent: int):
    def similar(i: int, later: np.ndarray) -> np.ndarray:
        differ = np.bitwise_count(bits[later] ^ bits[i]).sum(axis=1, dtype=np.int64)
        # differing bits <= differing shingles <= (a + b) * (100 - percent) / (100 + percent)
        return later[differ * (100 + percent) <= (sizes[later] + sizes[i]) * (100 - percent)]
    return similar


def numbered(values: np.ndarray) -> np.ndarray:
    """Equal shingles get equal numbers, from 0 on."""
    order = np.argsort(values[:, 0], kind="stable")
    if _collides(values[order], np.zeros(len(values))):
        order = np.lexsort((values[:, 1], values[:, 0]))
    new = np.concatenate([[0], (values[order[1:]] != values[order[:-1]]).any(axis=1)])
    out = np.empty(len(values), np.int64)
    out[order] = np.cumsum(new)
    return out


def _exactly(sizes: np.ndarray, bits: np.ndarray, arrays: list[np.ndarray], percent: int):
    """Exact intersections: the shingles of one set are marked, those of the others looked up."""
    bound, number, first = _by_bitmap(sizes, bits, percent), numbered(np.concatenate(arrays)), np.cumsum([0, *map(len, arrays)])
    marked = np.zeros(int(number.max(initial=0)) + 1, np.int64)

    def similar(i: int, later: np.ndarray) -> np.ndarray:
        later = bound(i, later)
        if not len(later):
            return later
        marked[number[first[i]:first[i + 1]]] = 1
        length = sizes[later]
        ends = np.cumsum(length)
        at = np.repeat(first[later] - ends + length, length) + np.arange(ends[-1])
        common = np.add.reduceat(marked[number[at]], ends - length)
        marked[number[first[i]:first[i + 1]]] = 0
        return later[100 * common >= percent * (length + sizes[i] - common)]
    return similar


def _tiles(percent: int, exact: bool, count: bool):
    """Links within each tile of a partition sorted by (grp, i, j); rows: grp, i, j, digest, n, bits, mine[, shingles,
    times]. Out come links (a, b, null) and, if asked for, numbers of links (a, null, links)."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("links", pa.int64())])

    def links(tile: tuple | None, rows: list[tuple]) -> list[tuple]:
        rows = sorted({r[0]: r for r in rows}.values(), key=lambda r: (r[1], r[0]))
        if len(rows) < 2:
            return []
        sizes, bits = np.array([r[1] for r in rows]), _fold([r[2] for r in rows])
        blocks = None if tile[1] == tile[2] else np.array([r[3] for r in rows])
        similar, weights = _by_bitmap(sizes, bits, percent), None
        if exact:
            similar = _exactly(sizes, bits, [np.frombuffer(r[4], np.uint64).reshape(-1, 2) for r in rows], percent)
            weights = np.array([r[5] for r in rows]) if count else None
        edges, sums = connect(sizes, blocks, percent, similar, weights)
        return [(rows[i][0], rows[j][0], None) for i, j in edges] + [(rows[i][0], None, int(sums[i])) for i in np.flatnonzero(sums)]

    def batch_of(out):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * 3, schema)], schema=schema)

    def run(batches):
        held, at, out = [], None, []
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for tile, row in zip(zip(*columns[:3]), zip(*columns[3:])):
                if tile != at:
                    out += links(at, held)
                    held, at = [], tile
                held.append(row)
            yield batch_of(out)
            out = []
        yield batch_of(links(at, held))
    return run


def _linked(members: DataFrame, counts: DataFrame, percent: int, block: int, exact: bool, count: bool = False) -> DataFrame:
    """(a, b, links) among the members of each group; counts: (grp, m). Large groups are cut into blocks."""
    columns = ["digest", "n", "bits", "mine", *(["shingles", "times"] if exact else [])]
    cut = members.join(counts, "grp").withColumn("blocks", F.ceil(F.col("m") / block).cast("long"))
    cut = cut.withColumn("mine", F.pmod(F.xxhash64("digest"), F.col("blocks")))
    cut = cut.select("*", F.explode(F.expr("sequence(0L, blocks - 1)")).alias("other"))
    cut = cut.select("grp", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), *columns)
    cut = cut.repartition("grp", "i", "j").sortWithinPartitions("grp", "i", "j")
    return cut.mapInArrow(_tiles(percent, exact, count), "a binary, b binary, links bigint")


def _placed(docs: DataFrame, percent: int, width: int, id_col: str, text_col: str, block: int, frequent: int,
            packets: int | None, count: bool) -> DataFrame:
    """doc_id, text_digest, n_shingles, component, component_id, n_links for every row. ``component`` tells components
    with equal least ids apart: the least digest of its sets, null for a text without shingles."""
    if not 50 < percent < 100:
        raise ValueError("percent has to lie between 50 and 100")
    spark = docs.sparkSession
    prepare(spark)
    rows = texts(docs, id_col, text_col)
    told = rows.withColumn("text_digest", text_key(F.col("text")))
    sets = materialize(told.mapInArrow(_rows(width, percent), "doc_id bigint, digest binary, n bigint, bits binary, id bigint, "
                                                              "text_digest binary, posts bigint"), "sets")
    most = sets.agg(F.sum("posts")).head()[0] or 0
    packets = max(packets or 0, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-most // PACKET_POSTS))
    packed = rows.mapInArrow(_packets(width, percent, packets, PACKED_POSTS, frequent),
                             "packet int, keys binary, ids binary, counts binary, frequent boolean")
    met = packed.repartition(packets, "packet").sortWithinPartitions("packet", "frequent").mapInArrow(
        _shared, "grp bigint, id bigint")
    met = materialize(met, "shared-posts")
    # One of the rows of a class stands for it: (id, text), and how many rows have both.
    told = sets.groupBy("digest", "doc_id", "text_digest").agg(
        F.count(F.lit(1)).alias("rows"), F.first("n").alias("n"), F.first("bits").alias("bits"), F.first("id").alias("id"))
    classes = told.groupBy("digest").agg(
        F.min("doc_id").alias("own"), F.sum("rows").alias("times"), F.first("n").alias("n"), F.first("bits").alias("bits"),
        F.first("id").alias("id"), F.min(F.struct("doc_id", "text_digest", "rows")).alias("by"))
    classes = materialize(classes, "classes")
    counts = met.groupBy("grp").agg(F.count(F.lit(1)).alias("m"))
    members = met.join(classes.where("bits is not null").select("id", "digest", "n", "bits"), "id")
    found = components(_linked(members, counts, percent, block, exact=False).select("a", "b"), "candidates")
    found = materialize(found.withColumnsRenamed({"node": "digest", "root": "grp"}), "candidates")
    wanted = classes.join(found, "digest").select(
        F.col("by.doc_id").alias("kept_id"), F.col("by.text_digest").alias("kept_digest"), F.col("by.rows").alias("times"),
        "digest", "grp", "n", "bits", F.col("times").alias("weight"))
    arrays = rows_of(rows, wanted, text_key(F.col("text")), "doc_id", "digest", "grp", "n", "bits", "weight")
    arrays = arrays.mapInArrow(_arrays(width), "digest binary, grp binary, n bigint, bits binary, times bigint, shingles binary")
    linked = materialize(_linked(arrays, found.groupBy("grp").agg(F.count(F.lit(1)).alias("m")), percent, block, True, count),
                         "links")
    joined = components(linked.where("b is not null").select("a", "b"), "links")
    roots = joined.join(classes.select(F.col("digest").alias("node"), "own"), "node")
    least = roots.groupBy("root").agg(F.min("own").alias("least"), F.min("node").alias("component"))
    roots = roots.join(least, "root").select(F.col("node").alias("digest"), "least", "component")
    links = linked.where("b is null").groupBy(F.col("a").alias("digest")).agg(F.sum("links").alias("links"))
    # Texts without shingles share a digest but link with nothing.
    named = classes.select("digest", "own", "times").join(roots, "digest", "left").join(links, "digest", "left").select(
        "digest", "times", F.coalesce(F.least("own", "least"), "own").alias("least"),
        F.coalesce("component", "digest").alias("component"), (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("links"))
    some = F.col("n") > 0
    return lookup(sets.select("doc_id", "text_digest", "n", "digest"), named, "digest", "times").select(
        "doc_id", "text_digest", F.col("n").alias("n_shingles"), F.when(some, F.col("component")).alias("component"),
        F.when(some, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(some, F.col("links")).otherwise(0).alias("n_links"))


def similar_components(docs: DataFrame, percent: int = 80, width: int = 5, id_col: str = "doc_id",
                       text_col: str = "text", block: int = BLOCK, frequent: int = FREQUENT,
                       packets: int | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links for every row.

    A-Z are lower-cased; words are `[^\\x20\\x09-\\x0D]+`; a text with fewer than ``width`` words has its whole word
    sequence as its one shingle. Rows link when 100 * intersection >= percent * union; ``n_links`` counts the other rows
    that a row links with, copies included; ``component_id`` is the smallest id reachable by links, the row's own
    included. Texts without words, and nulls, have no shingles and link with nothing. Equal sets link whatever their
    ids; a component of null ids alone has a null component_id. Repeated rows give repeated results; an empty table
    gives none; other columns are ignored. ``packets`` is the least number of packets of posts; there are more if
    spark.sql.shuffle.partitions or the number of posts asks for it.
    """
    return _placed(docs, percent, width, id_col, text_col, block, frequent, packets, True).select(
        "doc_id", "n_shingles", "component_id", "n_links")


def one_of_each(docs: DataFrame, percent: int = 80, width: int = 5) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id. Columns stay as they are.

    Of rows that share that id the one with the least text digest stays, and of those that share the text any one; an
    id in several components is decided in each by itself. Of null ids alone one row stays; next to any id a null id
    loses. Texts without shingles, null ones too, link with nothing, so of each id with such a text one row stays. An
    empty table gives none; columns of any name are kept. No text is cut.
    """
    placed = _placed(docs, percent, width, "doc_id", "text", BLOCK, FREQUENT, None, False)
    rows = placed.where("n_shingles > 0").groupBy("component", "doc_id", "text_digest").agg(F.count(F.lit(1)).alias("times"))
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("kept_id"),
                           F.col("text_digest").alias("kept_digest"), "times")).alias("first")
    kept = rows.groupBy("component").agg(first).select("first.kept_id", "first.kept_digest", "first.times")
    alone = placed.where("n_shingles = 0").select(F.col("doc_id").alias("kept_id"), F.col("text_digest").alias("kept_digest"),
                                                  F.lit(1).cast("long").alias("times")).distinct()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return rows_of(docs, kept.unionByName(alone), text_key(text))
