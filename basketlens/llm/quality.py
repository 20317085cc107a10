"""Document quality by a byte-level convolutional network in numpy.

Every byte of a document has a learned vector; learned filters slide over them. Half-overlapping chunks that cover
the whole document are described by the mean and the largest response of each filter, a hidden layer reads each
chunk, its units are max-pooled over all chunks, and a logistic unit turns them into one probability. Fitting uses
a bounded sample of labelled rows; scoring reads whole texts and nothing but them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import flat, pieces, prepare, texts

#: Network shape: bytes of half a chunk, step and width of a filter in bytes, sizes of byte vector, filters, hidden layer.
HALF, STEP, TAPS, VECTOR, FILTERS, HIDDEN = 128, 2, 3, 8, 16, 16
PLACES = HALF // STEP
#: Bytes of a piece of a long text, and bytes from which on a text is long in fitting.
PIECE, LONG = 1 << 18, 1 << 13


@dataclass(frozen=True)
class Fit:
    """Bounds and settings of the fit. The sample is the rows with the smallest hash of doc_id."""

    sample_rows: int = 5000
    steps: int = 940  # whole passes over the sample until so many batches are done
    batch: int = 32
    rate: float = 0.004
    seed: int = 7


@dataclass
class Layout:
    """Texts laid out in half chunks: each starts at a half chunk and ends with enough zero bytes for a filter."""

    symbols: np.ndarray  # all bytes and the last filter's reach
    valid: np.ndarray  # (half chunks, places): the filter starts inside the text
    left: np.ndarray  # the half chunks of each chunk; right is left for a text of one half chunk
    right: np.ndarray
    first: np.ndarray  # first chunk of each text


def _halves(length):
    """Half chunks of a text: room for its bytes and a filter."""
    return (length + STEP * TAPS + HALF - 1) // HALF


def side_by_side(layouts: list[Layout]) -> Layout:
    """Layouts of different texts as one."""
    reach = STEP * (TAPS - 1)
    halves = np.cumsum([0, *(len(x.valid) for x in layouts)])
    chunks = np.cumsum([0, *(len(x.left) for x in layouts)])
    symbols = [x.symbols[:len(x.valid) * HALF] for x in layouts] + [np.zeros(reach, np.uint8)]
    return Layout(np.concatenate(symbols), np.concatenate([x.valid for x in layouts]),
                  np.concatenate([x.left + a for x, a in zip(layouts, halves)]),
                  np.concatenate([x.right + a for x, a in zip(layouts, halves)]),
                  np.concatenate([x.first + a for x, a in zip(layouts, chunks)]))


def long_pieces(data: np.ndarray, piece: int = PIECE) -> Iterator[Layout]:
    """All chunks of one text, in order, a run of them at a time. A run is laid out with the two half chunks that
    follow it, which its last chunk and that one's filters reach into."""
    step, total = piece // HALF, max(1, _halves(len(data)) - 1)
    for begin in range(0, total, step):
        part = data[begin * HALF:(begin + step + 2) * HALF]
        x = lay_out(part, np.array([0, len(part)]))
        yield replace(x, left=x.left[:total - begin][:step], right=x.right[:total - begin][:step])


def strongest(net: Net, data: np.ndarray, piece: int = PIECE) -> Layout:
    """One text laid out with only those chunks that are highest in some hidden unit."""
    best = np.full(HIDDEN, -1.0, np.float32)
    at = np.zeros(HIDDEN, np.int64)
    for number, x in enumerate(long_pieces(data, piece)):
        h = net.chunks(x)
        top = h.argmax(axis=0)
        higher = h[top, np.arange(HIDDEN)] > best
        best[higher] = h[top, np.arange(HIDDEN)][higher]
        at[higher] = top[higher] + number * (piece // HALF)
    layouts = []
    for chunk in np.unique(at):
        part = np.zeros(3 * HALF, np.uint8)  # the chunk, and what its last filters reach into
        held = data[chunk * HALF:(chunk + 3) * HALF]
        part[:len(held)] = held
        valid = (chunk * HALF + np.arange(0, 3 * HALF, STEP) < len(data)).reshape(3, PLACES)
        valid[2] = False
        right = np.full(1, min(1, _halves(len(data)) - 1))
        layouts.append(Layout(part, valid, np.zeros(1, np.int64), right, np.zeros(1, np.int64)))
    x = side_by_side(layouts)
    return replace(x, first=x.first[:1])


def lay_out(data: np.ndarray, offsets: np.ndarray) -> Layout:
    lengths = np.diff(offsets)
    halves = _halves(lengths)
    begin = np.concatenate([[0], np.cumsum(halves)])
    total = int(begin[-1])
    symbols = np.zeros(total * HALF + STEP * (TAPS - 1), np.uint8)
    moved = np.repeat(begin[:-1] * HALF - offsets[:-1], lengths)
    symbols[np.arange(len(data)) + moved] = data
    text_of = np.repeat(np.arange(len(lengths)), halves)
    within = (np.arange(total) - begin[text_of]) * HALF
    valid = within[:, None] + np.arange(0, HALF, STEP) < lengths[text_of][:, None]
    last = np.zeros(total, bool)
    last[begin[1:] - 1] = True
    alone = last & (halves[text_of] == 1)
    left = np.flatnonzero(~last | alone)
    right = np.where(alone[left], left, left + 1)
    chunks = np.maximum(halves - 1, 1)
    return Layout(symbols, valid, left, right, np.concatenate([[0], np.cumsum(chunks)[:-1]]))


def _highest(z: np.ndarray) -> np.ndarray:
    """z.max(axis=1) by halving the axis, which stays in long contiguous passes."""
    while z.shape[1] > 1:
        half = z.shape[1] // 2
        z = np.maximum(z[:, :half], z[:, half:])
    return z[:, 0]


class Net:
    SHAPES = {"bytes": (256, VECTOR), "taps": (TAPS, STEP * VECTOR, FILTERS), "shift": (FILTERS,),
              "hidden": (2 * FILTERS, HIDDEN), "hidden_shift": (HIDDEN,), "out": (HIDDEN,), "out_shift": (1,)}

    def __init__(self, weights: dict[str, np.ndarray] | None = None, seed: int = 0):
        random = np.random.default_rng(seed)
        self.w = weights or {name: (random.normal(size=shape) / np.sqrt(max(1, shape[-2] if len(shape) > 1 else 4))
                                    * ("shift" not in name)).astype(np.float32) for name, shape in self.SHAPES.items()}
        self.w["bytes"][0] = 0  # padding

    def forward(self, x: Layout, keep: bool = False):
        w, places = self.w, x.valid.size
        a = np.take(w["bytes"], x.symbols, axis=0).reshape(-1, STEP * VECTOR)
        z = a[:places] @ w["taps"][0]
        for t in range(1, TAPS):
            z += a[t:places + t] @ w["taps"][t]
        z += w["shift"]
        np.maximum(z, 0, out=z)
        z[np.flatnonzero(~x.valid.reshape(-1))] = 0
        z = z.reshape(-1, PLACES, FILTERS)
        number = x.valid.sum(axis=1).astype(np.float32)
        sums, highest = np.einsum("hpf->hf", z), _highest(z)
        two = (x.left != x.right)[:, None]
        size = np.maximum(number[x.left] + number[x.right] * two[:, 0], 1)[:, None]
        mean = (sums[x.left] + sums[x.right] * two) / size
        c = np.concatenate([4 * mean, np.maximum(highest[x.left], highest[x.right])], axis=1)
        h = np.maximum(c @ w["hidden"] + w["hidden_shift"], 0)
        pooled = np.maximum.reduceat(h, x.first, axis=0)
        return (self.logit(pooled), a, z, highest, two, size, c, h, pooled) if keep else (h, pooled)

    def chunks(self, x: Layout) -> np.ndarray:
        """Hidden units of every chunk."""
        return self.forward(x)[0]

    def pooled(self, x: Layout) -> np.ndarray:
        """Highest hidden units of every text."""
        return self.forward(x)[1]

    def logit(self, pooled: np.ndarray) -> np.ndarray:
        return (pooled * self.w["out"]).sum(axis=1) + self.w["out_shift"]

    def gradients(self, x: Layout, label: np.ndarray) -> dict[str, np.ndarray]:
        logit, a, z, highest, two, size, c, h, pooled = self.forward(x, keep=True)
        w, g, n = self.w, {}, len(label)
        d = ((1 / (1 + np.exp(-logit)) - label) / n).astype(np.float32)
        g["out"], g["out_shift"] = d @ pooled, d.sum(keepdims=True)
        counts = np.diff(np.append(x.first, len(x.left)))
        text_of = np.repeat(np.arange(n), counts)
        top = (h == pooled[text_of]) & (h > 0)
        share = np.maximum(np.add.reduceat(top, x.first, axis=0), 1)
        dh = top * (d[:, None] * w["out"] / share)[text_of]
        g["hidden"], g["hidden_shift"] = c.T @ dh, dh.sum(axis=0)
        dc = dh @ w["hidden"].T
        dmean, dhigh = 4 * dc[:, :FILTERS] / size, dc[:, FILTERS:]
        dsum, dmax = np.zeros_like(highest), np.zeros_like(highest)
        np.add.at(dsum, x.left, dmean), np.add.at(dsum, x.right, dmean * two)
        from_left = highest[x.left] >= highest[x.right]
        np.add.at(dmax, x.left, dhigh * from_left), np.add.at(dmax, x.right, dhigh * ~from_left)
        dz = (z > 0) * dsum.astype(a.dtype)[:, None, :]
        half, unit = np.nonzero((highest > 0) & (dmax != 0))
        dz[half, z[half, :, unit].argmax(axis=1), unit] += dmax[half, unit]
        dz = dz.reshape(-1, FILTERS)
        places = len(dz)
        g["shift"] = dz.sum(axis=0)
        g["taps"] = np.stack([a[t:places + t].T @ dz for t in range(TAPS)])
        da = np.zeros_like(a)
        for t in range(TAPS):
            da[t:places + t] += dz @ w["taps"][t].T
        da = da.reshape(-1, VECTOR)
        g["bytes"] = np.stack([np.bincount(x.symbols, da[:, i], 256) for i in range(VECTOR)], axis=1)
        g["bytes"][0] = 0
        return g


def fit(sample: list[tuple[bytes, int]], settings: Fit = Fit()) -> Net:
    """Adam over the sample in a fixed order; without labelled rows every score is 0.5."""
    net = Net(seed=settings.seed)
    if not sample:
        net.w = {name: np.zeros_like(value) for name, value in net.w.items()}
        return net
    random = np.random.default_rng(settings.seed)
    first = {k: np.zeros_like(v) for k, v in net.w.items()}
    second = {k: np.zeros_like(v) for k, v in net.w.items()}
    batches = -(-len(sample) // settings.batch)
    steps, total = 0, batches * -(-settings.steps // batches)
    while steps < total:
        order = random.permutation(len(sample))
        for at in range(0, len(order), settings.batch):
            rows = sorted((sample[i] for i in order[at:at + settings.batch]), key=lambda r: len(r[0]) > LONG)
            short = [np.frombuffer(t, np.uint8) for t, _ in rows if len(t) <= LONG]
            layouts = [lay_out(np.concatenate(short), np.cumsum([0, *map(len, short)]))] if short else []
            layouts += [strongest(net, np.frombuffer(t, np.uint8)) for t, _ in rows if len(t) > LONG]
            x = side_by_side(layouts)
            steps += 1
            rate = settings.rate * min(1, steps / 50) * (1 - 0.95 * steps / total)
            for k, g in net.gradients(x, np.array([y for _, y in rows], np.float32)).items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.98 * second[k] + 0.02 * g * g
                bent = second[k] / (1 - 0.98 ** steps)
                net.w[k] = (net.w[k] - rate * first[k] / (1 - 0.9 ** steps) / (np.sqrt(bent) + 1e-7)).astype(np.float32)
    return net


def held_out(doc_id: Column) -> Column:
    """True for the third of ids on which nothing is learned; a null id is not in it."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, settings: Fit = Fit()) -> Net:
    """Learn from at most ``sample_rows`` labelled rows outside the held-out third, and from the whole text of each."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("__quality"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.sample_rows))
    rows = (texts(docs).join(F.broadcast(known), "doc_id")  # at most sample_rows rows
            .select("doc_id", "text", "__quality").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(settings.sample_rows).collect())
    return fit([(r.text.encode("utf-8", "replace"), int(r["__quality"] == 1)) for r in rows], settings)


def probabilities(net: Net, column: pa.Array) -> np.ndarray:
    data, offsets = flat(column)
    found = []
    for a, b in pieces(offsets, PIECE):
        text = data[offsets[a]:offsets[b]]
        if b - a == 1 and len(text) > PIECE:
            pooled = np.stack([net.chunks(x).max(axis=0) for x in long_pieces(text)]).max(axis=0, keepdims=True)
        else:
            pooled = net.pooled(lay_out(text, offsets[a:b + 1] - offsets[a]))
        found.append(net.logit(pooled))
    logit = np.concatenate(found).astype(np.float64) if found else np.zeros(0)
    return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def score(docs: DataFrame, net: Net, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) for every row. A null text is empty, and an empty text has a score like any other: that of
    a chunk without bytes. Rows map one to one, repeated ones too; other columns play no part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        local = Net({k: v.copy() for k, v in shared.value.items()})
        for batch in batches:
            found = pa.array(probabilities(local, batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), found], ["doc_id", "score"])

    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(net.w)  # a few thousand numbers
    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, score double")


def quality_report(docs: DataFrame, labels: DataFrame, settings: Fit = Fit()) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Null texts count as empty ones, and these have a score like any other. Repeated rows, also of one id with several
    texts, give a row each; a null id is not held out and, having no label, never learned from. Of an id with several
    labels the largest counts; without labelled rows every score is 0.5. Texts of any length are read whole. An empty
    table gives no rows; other columns, whatever their names, are ignored.
    """
    return score(docs, train(docs, labels, settings)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, settings: Fit = Fit()) -> DataFrame:
    """``docs`` without the rows that the network rejects; rows and columns stay as they are, and nothing is shuffled.

    Scores are those of ``quality_report``: null texts count as empty, repeated rows are judged alike, ids play no part.
    Without labelled rows all stay. An empty table stays empty.
    """
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, settings).w)

    def run(column: pa.Array) -> pa.Array:
        return pa.array(probabilities(Net({k: v.copy() for k, v in shared.value.items()}), column))

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.where(F.arrow_udf(run, "double")(text) >= 0.5)
