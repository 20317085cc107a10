"""Spelling variants: words that differ by one letter, found by range searches in k-d trees over letter counts.

One edit changes the letter counts of a word by at most one up and one down, so near words lie within L1 distance two;
and near words have equal lengths or lengths that differ by one. For each length a k-d tree, fitted on a bounded sample
of the words, cuts the space of letter counts into cells; each word is indexed in one cell of its length and asks the
cells of its own and of the next length whose boxes are within that distance. A cell is a unit of work: its words go
into a k-d tree of their own with tight boxes, the range searches prune by box, and the order of the letters is
verified for what is left. Cells that hold or are asked by many words are cut into tiles.

Each tile sends, for every word it knows, the number of near words and the best of them; pairs never leave a task.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import prepare
from basketlens.session import materialize

LEAST_LENGTH, LEAST_TIMES, RATIO, DROP_ONE_IN = 6, 5, 5, 199
#: Words of a cell, of a leaf inside it, in the sample that the cells are fitted on, and words that a tile is asked.
CELL, LEAF, SAMPLE, ASKED = 4096, 16, 100_000, 8192
#: Different words that a task counts before it passes them on; bytes of a text cut at a time; bytes compared at a time.
COUNTED, PIECE, COMPARED = 400_000, 1 << 20, 8 << 20

#: Latin-1 bytes of words (A-Z lower-cased), all others a space.
_LETTER = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))
#: Dimension of each letter: a to z, then À to ÿ.
_DIM = np.zeros(256, np.int64)
_DIM[97:123], _DIM[0xC0:] = np.arange(26), 26 + np.arange(64)
DIMS = 90


def words_of(text: str, most: int = PIECE) -> Counter:
    """How often each run of letters occurs in a text, as Latin-1 bytes with A-Z lower-cased."""
    raw = text.encode("latin-1", "replace")  # what isn't Latin-1 is no letter here, nor is the ? that stands for it
    counts: Counter = Counter()
    begin = 0
    while begin < len(raw):
        end = min(begin + most, len(raw))
        while end < len(raw) and _LETTER[raw[end]] != 32:
            end += 1
        counts.update(raw[begin:end].translate(_LETTER).split())
        begin = end
    return counts


def result_of(word: bytes, seed: int) -> bytes:
    """The word itself, or without one letter where its checksum, carried on from ``seed``, says so."""
    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), seed)
    if h % DROP_ONE_IN:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1:]


def _counted(least_length: int, most: int):
    def batch_of(totals: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in totals], pa.string()),
                                           pa.array(totals.values(), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[bytes, int] = {}
        for batch in batches:
            for doc, text in zip(*(c.to_pylist() for c in batch.columns)):
                seed = zlib.crc32(b"%s:" % (b"" if doc is None else b"%d" % doc))
                for word, n in words_of(text or "").items():
                    if len(word) >= least_length and len(word := result_of(word, seed)) >= least_length:
                        totals[word] = totals.get(word, 0) + n
                if len(totals) >= most:
                    yield batch_of(totals)
                    totals = {}
        yield batch_of(totals)
    return run


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH,
               least_times: int = LEAST_TIMES) -> DataFrame:
    """(word, n) of all words of whole texts with enough letters and occurrences."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counted = rows.mapInArrow(_counted(least_length, COUNTED), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_times)


def letters(words: list[str], length: int) -> np.ndarray:
    """Words of one length as rows of Latin-1 bytes."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), length)


def letter_counts(rows: np.ndarray) -> np.ndarray:
    n = len(rows)
    place = (np.arange(n)[:, None] * DIMS + _DIM[rows]).ravel()
    kind = np.int16 if rows.shape[1] < 1 << 14 else np.int32
    return np.bincount(place, minlength=n * DIMS).reshape(n, DIMS).astype(kind)


@dataclass
class Tree:
    """Nodes of a k-d tree: boxes of the counts below each, its children (-1 in a leaf), and the number of each leaf."""
    low: np.ndarray
    high: np.ndarray
    children: np.ndarray
    leaf: np.ndarray
    members: list[np.ndarray]


def _halves(points: np.ndarray) -> tuple[int, int] | None:
    """Dimension and largest count of the lower half, as even as it gets; None if all points are equal."""
    best, most = None, 0
    for d in np.flatnonzero(points.min(axis=0) != points.max(axis=0)):
        below = np.cumsum(np.bincount(points[:, d]))[:-1]
        even = np.minimum(below, len(points) - below)
        if (cut := int(even.argmax())) is not None and even[cut] > most:
            best, most = (int(d), cut), int(even[cut])
    return best


def build(points: np.ndarray, leaf_size: int, tight: bool) -> Tree:
    """A k-d tree whose leaves have ``leaf_size`` points at most, or more only if these are equal.

    Boxes are those of the points (``tight``), or those of the cuts alone, which hold for any point.
    """
    low, high, children, leaf, members = [], [], [], [], []
    kind, most = points.dtype, np.iinfo(points.dtype).max
    todo = [(np.arange(len(points)), np.zeros(points.shape[1], kind), np.full(points.shape[1], most, kind), -1, 0)]
    while todo:
        rows, lo, hi, parent, side = todo.pop()
        node = len(low)
        if parent >= 0:
            children[parent][side] = node
        inside = points[rows]
        low.append(inside.min(axis=0) if tight else lo)
        high.append(inside.max(axis=0) if tight else hi)
        children.append([-1, -1])
        cut = _halves(inside) if len(rows) > leaf_size else None
        if cut is None:
            leaf.append(len(members))
            members.append(rows)
            continue
        leaf.append(-1)
        d, value = cut
        below, hi_below, lo_above = inside[:, d] <= value, hi.copy(), lo.copy()
        hi_below[d], lo_above[d] = value, value + 1
        todo += [(rows[below], lo, hi_below, node, 0), (rows[~below], lo_above, hi, node, 1)]
    return Tree(np.array(low), np.array(high), np.array(children), np.array(leaf), members)


def reach(tree: Tree, points: np.ndarray, down: int, at_once: int = 1024) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(point, leaf) wherever a leaf's box can be reached by raising one count by one and lowering ``down`` counts by one."""
    for start in range(0, len(points), at_once):
        some = points[start:start + at_once]
        point, node = np.arange(len(some)), np.zeros(len(some), np.int64)
        while len(point):
            mine = some[point]
            up = np.maximum(tree.low[node] - mine, 0).sum(axis=1)
            below = np.maximum(mine - tree.high[node], 0).sum(axis=1)
            ok = (up <= 1) & (below <= down)
            point, node = point[ok], node[ok]
            ended = tree.leaf[node] >= 0
            if ended.any():
                yield start + point[ended], tree.leaf[node[ended]]
            point, node = point[~ended], node[~ended]
            point, node = np.concatenate([point, point]), tree.children[node].T.ravel()


def one_edit(asked: np.ndarray, held: np.ndarray) -> np.ndarray:
    """For rows of letters side by side: do they differ by one replaced letter, or by one inserted in ``held``?"""
    n = asked.shape[1]
    if held.shape[1] == n:
        return (asked != held).sum(axis=1) == 1
    ahead = np.logical_and.accumulate(asked == held[:, :n], axis=1).sum(axis=1)
    behind = np.logical_and.accumulate((asked == held[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return ahead + behind >= n


def near_pairs(asked: np.ndarray, held: np.ndarray, leaf_size: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """(row of ``asked``, row of ``held``) one edit apart; ``held`` has equal length or one letter more."""
    points, others = letter_counts(held), letter_counts(asked)
    used = np.flatnonzero(points.any(axis=0) | others.any(axis=0))
    points, others = points[:, used], others[:, used]
    tree = build(points, leaf_size, tight=True)
    sizes = np.array([len(m) for m in tree.members])
    first, members = np.concatenate([[0], np.cumsum(sizes)]), np.concatenate(tree.members)
    out = [(np.zeros(0, np.int64),) * 2]
    step = max(1, COMPARED // held.shape[1])
    for point, leaf in reach(tree, others, int(asked.shape[1] == held.shape[1])):
        total = np.cumsum(sizes[leaf])
        begin = 0
        while begin < len(point):  # runs of about ``step`` pairs, each leaf whole
            end = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + step, side="right")))
            size = sizes[leaf[begin:end]]
            a = np.repeat(point[begin:end], size)
            b = members[np.repeat(first[leaf[begin:end]] - np.cumsum(size) + size, size) + np.arange(size.sum())]
            near = one_edit(asked[a], held[b])
            out.append((a[near], b[near]))
            begin = end
    return tuple(np.concatenate(x) for x in zip(*out))


def _best(of: np.ndarray, near: np.ndarray, n: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per word of ``of``: its near words, and the one of largest n, the smallest of equals. ``words`` are sorted."""
    order = np.lexsort((near, -n[near], of))
    of, near = of[order], near[order]
    begin = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else np.zeros(0, np.int64)
    return of[begin], np.diff(np.append(begin, len(of))), n[near[begin]], words[near[begin]]


NEAR = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def _tile(held: list[tuple[str, int]], asked: list[tuple[str, int]]) -> pa.RecordBatch:
    """What one tile knows of the words it holds and of those it is asked."""
    held, asked = sorted(held), sorted(asked)
    (words, n), (others, m) = ((np.array(w, object), np.array(k, np.int64)) for w, k in (zip(*held), zip(*asked)))
    longer = len(words[0]) > len(others[0])
    a, b = near_pairs(letters(list(others), len(others[0])), letters(list(words), len(words[0])))
    found, count, best_n, best = _best(a, b, n, words)
    parts = [(others[found], count, best_n, best)]
    if longer:  # words of equal length ask each other, a longer one is only asked
        found, count, best_n, best = _best(b, a, m, others)
        parts.append((words[found], count, best_n, best))
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), f.type) for c, f in zip(zip(*parts), NEAR)], schema=NEAR)


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (length, cell, i, j, asking, word, n), sorted by the first four."""
    at, held = None, {}

    def done():
        if held.get(0):
            for extra in (1, 2):  # words of the same length, words that are one letter shorter
                if held.get(extra):
                    yield _tile(held[0], held[extra])
    for batch in batches:
        for *tile, asking, word, n in zip(*(c.to_pylist() for c in batch.columns)):
            if tile != at:
                yield from done()
                at, held = tile, {}
            held.setdefault(asking, []).append((word, n))
    yield from done()


def _cells(words: DataFrame, cell: int, sample: int) -> dict[int, Tree]:
    """Per length with more than ``cell`` words a k-d tree of cells, fitted on about ``sample`` words in all."""
    many = words.groupBy(F.length("word").alias("length")).agg(F.count(F.lit(1)).alias("words")).where(F.col("words") > cell)
    many = {r.length: r.words for r in many.collect()}  # few: each stands for over ``cell`` words
    if not many:
        return {}
    one_in = -(-sum(many.values()) // sample)
    few = words.where(F.length("word").isin(list(many)) & (F.pmod(F.xxhash64("word"), F.lit(one_in)) == 0))
    by_length: dict[int, list[str]] = {}
    for r in few.select("word").collect():
        by_length.setdefault(len(r.word), []).append(r.word)
    out = {}
    for length, some in by_length.items():
        share = max(1, len(some) * cell // many[length])  # points of the sample that stand for a cell
        out[length] = build(letter_counts(letters(some, length)), share, tight=False)
        out[length].members = [None] * len(out[length].members)
    return out


def _post(trees: dict[int, Tree]):
    """Each word in its own cell (asking 0) and in the cells it asks: of its own length (1) and of the next one (2)."""
    def cells_of(tree: Tree | None, points: np.ndarray, up: int, down: int):
        if tree is None:
            return np.arange(len(points)), np.zeros(len(points), np.int64)
        if up:
            return tuple(np.concatenate(x) for x in zip(*reach(tree, points, down)))
        node = np.zeros(len(points), np.int64)
        while (inner := np.flatnonzero(tree.leaf[node] < 0)).size:
            left = tree.children[node[inner], 0]
            here = ((points[inner] >= tree.low[left]) & (points[inner] <= tree.high[left])).all(axis=1)
            node[inner] = np.where(here, left, tree.children[node[inner], 1])
        return np.arange(len(points)), tree.leaf[node]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, n = batch.column(0).to_pylist(), batch.column(1).to_numpy(zero_copy_only=False)
            sizes = np.array([len(w) for w in words])
            for length in np.unique(sizes):
                here = np.flatnonzero(sizes == length)
                for some in np.array_split(here, max(1, len(here) * int(length) // COMPARED)):
                    points = letter_counts(letters([words[i] for i in some], int(length)))
                    for asking, of, up, down in ((0, length, 0, 0), (1, length, 1, 1), (2, length + 1, 1, 0)):
                        row, cell = cells_of(trees.get(int(of)), points, up, down)
                        m = len(row)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(m, of, np.int32)), pa.array(cell.astype(np.int32)),
                             pa.array(np.full(m, asking, np.int32)), batch.column(0).take(pa.array(some[row])), pa.array(n[some[row]])],
                            ["length", "cell", "asking", "word", "n"])
    return run


def near_words(words: DataFrame, cell: int = CELL, sample: int = SAMPLE, asked: int = ASKED) -> DataFrame:
    """(word, n_near, best_n, best): every word of (word, n) that has near ones, how many, and the best of them."""
    trees = _cells(words, cell, sample)
    posts = words.mapInArrow(_post(trees), "length int, cell int, asking int, word string, n bigint")
    posts = materialize(posts, "letter-cells")
    counts = posts.groupBy("length", "cell").agg(F.count_if(F.col("asking") == 0).alias("held"), F.count_if(F.col("asking") > 0).alias("asks"))
    blocks = lambda n, most: F.ceil(F.col(n) * F.greatest("length", F.lit(64)) / (64 * most)).cast("int")
    counts = counts.where("held > 0 and asks > 0").select("length", "cell", blocks("held", 2 * cell).alias("rows"),
                                                          blocks("asks", asked).alias("columns"))
    tiles = posts.join(counts, ["length", "cell"])
    own = lambda n: F.pmod(F.xxhash64("word"), F.col(n)).cast("int")
    held = tiles.where("asking = 0").withColumn("i", own("rows")).withColumn("j", F.explode(F.expr("sequence(0, columns - 1)")))
    asks = tiles.where("asking > 0").withColumn("j", own("columns")).withColumn("i", F.explode(F.expr("sequence(0, rows - 1)")))
    columns = ["length", "cell", "i", "j", "asking", "word", "n"]
    dealt = held.select(columns).unionByName(asks.select(columns)).repartition(*columns[:4]).sortWithinPartitions(*columns[:4])
    found = dealt.mapInArrow(_tiles, "word string, n_near bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), "best")).alias("first")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("first.minus")).alias("best_n"), F.col("first.best").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): the end of each chain of forms. Each round doubles the steps of every chain.

    A form occurs ``RATIO`` times as often as its word at least, so chains have no circles and few steps.
    """
    roots = materialize(forms.withColumnRenamed("form", "root"), "roots")
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = roots.join(ahead, "root", "left")
        moved = materialize(moved.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        roots = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return roots


def spelling_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ratio: int = RATIO,
                    cell: int = CELL, sample: int = SAMPLE, asked: int = ASKED) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word.

    Runs of A-Z, a-z and U+00C0 to U+00FF of the whole texts, only A-Z lower-cased, are words, but where the crc32 of
    `<doc_id>:<run>` is a multiple of 199 the letter at that number, modulo the length, is left out. Words have at least
    6 letters and 5 occurrences (n). Near words differ by one inserted, deleted or replaced letter. The form is the near
    word of largest n, the smallest in code-point order of equals, if its n is at least ``ratio`` times the word's, else
    null with form_n; root is the end of the chain of forms, the word itself without one. Null texts have no words, a
    null id counts as an empty one in the crc32; repeated rows count each; an empty table gives no rows; other columns
    are ignored. ``sample`` words fit the cells; every word is indexed and asks, whatever the cells are.
    """
    prepare(docs.sparkSession)
    words = materialize(vocabulary(docs, id_col, text_col), "vocabulary")
    found = words.join(near_words(words, cell, sample, asked), "word", "left")
    has_form = F.col("best_n") >= ratio * F.col("n")
    found = materialize(found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                     F.when(has_form, F.col("best")).alias("form"), F.when(has_form, F.col("best_n")).alias("form_n")), "forms")
    roots = _roots(found.where("form is not null").select("word", "form"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
