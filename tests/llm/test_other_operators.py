"""Packing, quality and neighbours: against naive versions, held-out rows and brute force."""

import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from basketlens.llm import neighbours, packing, quality

SF = "/root/testdata/sf0.01"


def naive_best_fit(lengths, sources, clusters, capacity):
    bins, out = [], []
    for length, source, cluster in zip(lengths, sources, clusters):
        fits = [(b[0], k) for k, b in enumerate(bins)
                if b[0] >= length and (source is None or source not in b[1]) and cluster not in b[2]]
        k = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append([capacity, set(), set()])
        out.append((k, capacity - bins[k][0]))
        bins[k][0] -= length
        bins[k][1].add(source), bins[k][2].add(cluster)
    return out


def test_best_fit_equals_the_naive_search():
    draw = random.Random(2)
    for _ in range(200):
        n, capacity = draw.randint(1, 150), draw.choice([5, 20, 100])
        lengths = sorted((draw.randint(1, capacity) for _ in range(n)), reverse=True)
        sources = [draw.choice([None, "hot", "hot", "a", "b", "c"]) for _ in lengths]
        clusters = [draw.randrange(n) for _ in lengths]
        assert packing.pack_shard(lengths, sources, clusters, capacity) == naive_best_fit(lengths, sources, clusters, capacity)


@pytest.mark.parametrize("shard_rows", [packing.SHARD_ROWS, 200])
def test_packing_of_documents(spark, shard_rows):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    packed = packing.pack(docs, capacity=500, shard_rows=shard_rows).collect()
    assert {r.doc_id for r in packed} == set(rows)
    by_bin, by_doc = {}, {}
    for r in packed:
        by_doc.setdefault(r.doc_id, []).append(r)
        if r.bin is not None:
            by_bin.setdefault(r.bin, []).append(r)
    for doc_id, parts in by_doc.items():
        assert sum(p.length for p in parts) == len(rows[doc_id].text.encode().split())
        assert sorted(p.piece for p in parts) == list(range(len(parts)))
        assert all(p.length == 500 for p in parts if p.piece < len(parts) - 1)
    for parts in by_bin.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.start):
            assert p.start == at
            at += p.length
        assert at <= 500
        assert len({rows[p.doc_id].source for p in parts}) == len(parts) == len({rows[p.doc_id].text for p in parts})


def test_packing_edge_cases(spark):
    docs = spark.createDataFrame(
        [(1, None, "a", 9), (2, "", "a", 9), (None, "w " * 25, None, 9), (4, "w " * 3, None, 9), (5, "v " * 3, None, 9),
         (5, "v " * 3, None, 9)], "doc_id long, text string, source string, length int")
    got = packing.pack(docs, capacity=10).collect()
    assert sorted((r.doc_id or 0, r.piece, r.length) for r in got) == [
        (0, 0, 10), (0, 1, 10), (0, 2, 5), (1, 0, 0), (2, 0, 0), (4, 0, 3), (5, 0, 3), (5, 0, 3)]
    assert [r.doc_id for r in got if r.bin is None and r.start is None] and all(r.length == 0 for r in got if r.bin is None)
    copies = [r.bin for r in got if r.doc_id == 5]
    assert len(set(copies)) == 2
    assert packing.pack(docs.limit(0)).count() == 0


def test_packing_by_clusters_with_words(spark):
    """Near copies that a column calls one cluster never meet; every sequence holds its pieces' words, in order."""
    draw = random.Random(9)
    rows = [(draw.choice([i, i, None]), " \n".join(f"w{draw.randrange(9)}" for _ in range(draw.choice([0, 1, 3, 9, 30, 75]))),
             f"s{i % 41}", draw.choice([None, 1, 2, 3]), "x", "y") for i in range(300)]
    rows += [rows[0], (7, None, "s", 1, "x", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, family int, cluster string, rid string").repartition(4)
    got = packing.pack(docs, capacity=20, shard_rows=64, cluster_col="family", words=True).collect()
    plain = packing.pack(docs, capacity=20, shard_rows=64, cluster_col="family").collect()
    assert sorted(map(repr, (tuple(r)[:5] for r in got))) == sorted(map(repr, map(tuple, plain)))
    words = sorted(repr((i, p, " ".join((t or "").split()[p * 20:p * 20 + 20]))) for i, t, *_ in rows for p in range(max(1, -(-len((t or "").split()) // 20))))
    assert sorted(repr((r.doc_id, r.piece, r.text)) for r in got) == words
    assert all(len(r.text.split()) == r.length for r in got)
    bins = {}
    for r in got:
        bins.setdefault(r.bin, []).append(r)
    assert max(sum(p.length for p in parts) for b, parts in bins.items() if b is not None) <= 20


def test_packing_keeps_families_apart(spark):
    docs = spark.createDataFrame([(i, f"w{i} and more", f"s{i}", i % 2 if i < 8 else None) for i in range(12)],
                                 "doc_id long, text string, source string, family int")
    bins = {}
    for r in packing.pack(docs, capacity=100, cluster_col="family").collect():
        bins.setdefault(r.bin, []).append(r.doc_id)
    assert all(len([i for i in ids if i < 8 and i % 2 == k]) <= 1 for ids in bins.values() for k in (0, 1))
    assert max(map(len, bins.values())) == 6  # one of each family, and all that have none


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    return quality.quality_report(docs, labels).collect(), {r.doc_id: r.quality for r in labels.collect()}


def test_quality_on_rows_held_out(scored):
    rows, label = scored
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    judged = [(r.predicted, label[r.doc_id]) for r in rows if r.held_out and r.doc_id in label]
    assert len(judged) > 80
    assert np.mean([p == y for p, y in judged]) >= 0.95
    assert np.mean([p for p, y in judged if y == 1]) >= 0.97


def test_quality_gradients():
    texts = [b"some words, and more.", b"### $$$ &&&" * 60, b"", b"x" * 500]
    layout = quality.lay_out(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))
    net = quality.Net(seed=1)
    net.w = {k: v.astype(np.float64) + 0.01 * (k == "hidden_shift") for k, v in net.w.items()}
    label = np.array([1.0, 0, 1, 0])

    def loss():
        z = net.logit(net.pooled(layout))
        return np.mean(np.logaddexp(0, z) - label * z)

    for name, gradient in net.gradients(layout, label).items():
        at = np.unravel_index(np.argmax(np.abs(gradient)), gradient.shape)
        before = net.w[name][at]
        net.w[name][at] = before + 1e-5
        up = loss()
        net.w[name][at] = before - 1e-5
        down = loss()
        net.w[name][at] = before
        assert abs((up - down) / 2e-5 - gradient[at]) < 1e-3 * max(1, abs(gradient[at])), name


def test_quality_reads_whole_texts_and_nothing_else(spark):
    clean = "Some words and then, again, a sentence. " * 100
    docs = spark.createDataFrame([(1, clean, "en", "a", 0.1), (2, clean, "de", "b", 0.2), (2, clean, "de", "b", 0.2),
                                  (3, None, "en", None, None), (4, "", None, "c", 0.3), (None, clean + "### $$$ " * 400, "", "", 0.0)],
                                 "doc_id long, text string, lang string, source string, score double")
    net = quality.Net(seed=3)
    got = [(r.doc_id, r.score) for r in quality.score(docs, net).collect()]
    assert len(got) == 6 and len({s for i, s in got if i in (1, 2)}) == 1 and len({s for i, s in got if i in (3, 4)}) == 1
    assert dict(got)[None] != dict(got)[1]
    assert quality.score(docs.limit(0), net).count() == 0


def test_quality_of_long_texts_by_pieces():
    draw, net = np.random.default_rng(5), quality.Net(seed=2)
    for length in [*range(1, 400, 7), 1000, 1023, 1024, 1025, 1151, 1152, 1153, 5000, 70001]:
        text = draw.integers(1, 256, length).astype(np.uint8)
        whole = net.pooled(quality.lay_out(text, np.array([0, length])))[0]
        parts = np.stack([net.chunks(x).max(axis=0) for x in quality.long_pieces(text, 1024)]).max(axis=0)
        assert np.allclose(whole, parts, atol=1e-5), length
        assert np.allclose(whole, net.pooled(quality.strongest(net, text, 1024))[0], atol=1e-5), length


def test_quality_learns_from_the_strongest_chunks_what_whole_texts_teach():
    draw, net = np.random.default_rng(6), quality.Net(seed=4)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    texts = [draw.integers(1, 256, n).astype(np.uint8) for n in (3000, 700, 9000)]
    label = np.array([1.0, 0, 1])
    whole = quality.lay_out(np.concatenate(texts), np.cumsum([0, *map(len, texts)]))
    few = quality.side_by_side([quality.lay_out(texts[0], np.array([0, 3000])), *(quality.strongest(net, t, 1024) for t in texts[1:])])
    assert len(few.left) < len(whole.left) / 1.5
    a, b = net.gradients(whole, label), net.gradients(few, label)
    assert all(np.allclose(a[k], b[k], atol=1e-9) for k in a)


def test_quality_memory_does_not_grow_with_a_text():
    net, peaks = quality.Net(seed=1), []
    for length in (2_000_000, 20_000_000):
        column = pa.array(["some words, and " * (length // 16)])
        tracemalloc.start()
        quality.probabilities(net, column)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < peaks[0] + 5_000_000 < 300_000_000


def test_quality_without_labels(spark):
    docs = spark.createDataFrame([(1, "text"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    assert [tuple(r) for r in quality.quality_report(docs, labels).orderBy("doc_id").collect()] == [
        (i, zlib.crc32(str(i).encode()) % 3 == 1, 0.5, 1) for i in (1, 2)]
    assert quality.keep_good(docs, labels).count() == 2


def brute_nearest(rows, ids, k):
    out = set()
    for i, v in rows:
        if i in ids:
            near = sorted((float(np.sqrt(((v - w) ** 2).sum())), j) for j, w in rows if j != i)[:k]
            out |= {(i, j) for _, j in near}
    return out


def test_neighbours_recall(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = neighbours.nearest(vectors, vectors.where("vec_id % 50 = 0"), index_rows=700, query_rows=30).collect()
    rows = [(r.vec_id, np.array(r.embedding, np.float64)) for r in vectors.collect()]
    asked = {i for i, _ in rows if i % 50 == 0}
    want = brute_nearest(rows, asked, 10)
    assert len(want & {(r.query_id, r.vec_id) for r in got}) >= 0.9 * len(want)
    of = dict(rows)
    for r in got:
        assert abs(r.score - float(np.sqrt(((of[r.query_id] - of[r.vec_id]) ** 2).sum()))) < 1e-12
    for i in asked:
        mine = sorted((r.rank, r.score, r.vec_id) for r in got if r.query_id == i)
        assert [m[0] for m in mine] == list(range(1, 11)) and [m[1:] for m in mine] == sorted(m[1:] for m in mine)


def test_neighbours_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 2.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [None, 1.0]), (8, [1.0, 0.0]), (8, [1.0, 0.0]), (None, [1.0, 1.0]), (10, [])]
    vectors = spark.createDataFrame([(*r, 1, 0.5) for r in rows], "vec_id long, embedding array<double>, rank int, score double")
    got = [tuple(r) for r in neighbours.nearest(vectors, vectors, neighbours=2).orderBy("query_id", "rank").collect()]
    far = float(np.sqrt(5.0))
    assert got == [(0, 1, 1, 0.0), (0, 2, 8, 0.0), (1, 1, 0, 0.0), (1, 2, 8, 0.0), (2, 1, 0, far), (2, 2, 1, far),
                   (8, 1, 0, 0.0), (8, 1, 0, 0.0), (8, 2, 1, 0.0), (8, 2, 1, 0.0)]
    assert neighbours.nearest(vectors.limit(0), vectors).count() == 0
    assert neighbours.nearest(vectors, vectors.where(F.col("vec_id") < 0)).count() == 0
    with pytest.raises(ValueError, match="different lengths"):
        neighbours.nearest(vectors.union(vectors.limit(1).selectExpr("9L", "array(1.0D)", "1L", "0.5D")), vectors)


def test_neighbours_of_one_id_and_exact_search(spark):
    """Rows of one id are each other's candidates, equal rows too; with every row reranked the answer is exact."""
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.1]), (1, [0.0, 5.0])]
    schema = "vec_id long, embedding array<double>"
    vectors = spark.createDataFrame(rows, schema)
    got = {tuple(r)[:3]: r.score for r in neighbours.nearest(vectors, vectors.where("vec_id = 0"), neighbours=1).collect()}
    assert set(got) == {(0, 1, 0)} and got[0, 1, 0] == pytest.approx(0.1)
    draw = random.Random(8)
    rows = [(draw.randrange(60), [float(draw.randrange(4)) for _ in range(3)]) for _ in range(200)]
    vectors = spark.createDataFrame(rows, schema).repartition(4)
    kept = [(i, v) for i, v in rows if any(v)]
    want = []
    for a, (i, v) in enumerate(kept):
        near = sorted((float(np.sqrt(sum((x - y) ** 2 for x, y in zip(v, w)))), j) for b, (j, w) in enumerate(kept) if a != b)[:5]
        want += [(i, r + 1, j, d) for r, (d, j) in enumerate(near)]
    for how in ({"index_rows": 30, "query_rows": 20}, {}):
        got = neighbours.nearest(vectors, vectors, neighbours=5, share=1.0, **how).collect()
        assert sorted(map(tuple, got)) == sorted(want)
