"""Ranked search against scores of every document."""

import math
import random
import re

import numpy as np
import pytest

from basketlens.llm import lexical

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def cut(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, top=20):
    words = [(k, cut(t)) for k, t in docs]
    n_docs, n_terms = sum(bool(w) for _, w in words), sum(len(w) for _, w in words)
    df = {}
    for _, w in words:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        scores = []
        for k, w in words:
            m = 100 - 25 + (25 * len(w) * n_docs) // max(n_terms, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (1000000000 * w.count(t) // (1000 * w.count(t) + 12 * m)) for t in cut(text) if t in w)
            if score > 0:
                scores.append((-score, k is None, k or 0, k))
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:top])]
    return out


def corpus(draw, n, vocabulary=60):
    letters = ["w%d" % i for i in range(vocabulary)] + ["É", "Wà", "x_y", "C++"]
    weights = [1 / (i + 1) for i in range(len(letters))]
    return [(i, draw.choice([" ", ", ", "\n"]).join(draw.choices(letters, weights, k=draw.choice([1, 3, 10, 60])))) for i in range(n)]


def frames(spark, docs, items):
    d = spark.createDataFrame([(*r, "x", 1, 2, "y") for r in docs], "doc_id long, text string, n string, terms int, score int, item_id string")
    i = spark.createDataFrame([(*r, 7) for r in items], "item_id long, text string, number int")
    return d.repartition(3), i


@pytest.mark.parametrize("item_bytes, shard_postings", [(4 << 20, 2_000_000), (40, 50)])
def test_ranks_equal_brute_force(spark, item_bytes, shard_postings):
    draw = random.Random(12)
    docs = corpus(draw, 250) + [(900, None), (901, ""), (902, "--"), (None, "w5 w6 w59"), (1000, "W1 w2"), (1001, "w1 W2"), (1002, "w1 w2")]
    items = [(i, t) for i, (_, t) in enumerate(corpus(draw, 25))] + [(90, None), (91, "nowhere"), (92, "w1 w1 w1 w2")]
    got = lexical.search(*frames(spark, docs, items), item_bytes=item_bytes, shard_postings=shard_postings)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute(docs, items), key=repr)


def test_ties_go_to_the_smaller_id_across_shards(spark):
    docs = [(i, "same words") for i in range(200, 0, -1)] + [(None, "same words")] * 3 + [(0, "other")]
    got = [tuple(r) for r in lexical.search(*frames(spark, docs, [(1, "words")]), shard_postings=8).orderBy("rank").collect()]
    assert [(r, d) for _, r, d, _ in got] == [(i, i) for i in range(1, 21)]


def test_empty_tables(spark):
    for docs, items in (([], [(1, "a")]), ([(1, "a")], []), ([(1, None)], [(1, "a")]), ([(1, "b")], [(1, "a")])):
        assert lexical.search(*frames(spark, docs, items)).collect() == []


def test_repeated_items_and_documents_count_each(spark):
    docs, items = [(1, "a b"), (1, "a b"), (2, "c")], [(5, "a"), (5, "a")]
    got = sorted(map(tuple, lexical.search(*frames(spark, docs, items)).collect()))
    assert [r[:3] for r in got] == [(5, 1, 1), (5, 1, 1), (5, 2, 1), (5, 2, 1)]


def test_range_maxima():
    draw = np.random.default_rng(3)
    terms, docs = np.nonzero(draw.random((7, 90)) < 0.6)
    impacts = draw.integers(0, 50, len(terms))
    shard = lexical.Shard(terms, docs, impacts, 90)
    begins, ends = shard.spans(np.arange(7))
    for a, b in zip(begins, ends):
        i, j = np.array([(i, j) for i in range(a, b) for j in range(i, b + 1)]).T
        place, size = shard.largest(i, j)
        for x, y, p, s in zip(i, j, place, size):
            assert s == max(shard.impacts[x:y], default=0) and (x == y or shard.impacts[p] == s and x <= p < y)


@pytest.mark.parametrize("at_once", [1, 5, 64])
def test_intervals_give_what_all_documents_give(at_once):
    draw = np.random.default_rng(at_once)
    dense = draw.integers(0, 9, (12, 400)) * (draw.random((12, 400)) < 0.3)
    terms, docs = np.nonzero(dense)
    shard = lexical.Shard(terms, docs, dense[terms, docs], 400)
    for top in (1, 3, 20, 500):
        asked, often = np.array([0, 3, 4, 11]), np.array([1, 2, 1, 3])
        scores = often @ dense[asked]
        want = sorted((-s, d) for d, s in enumerate(scores.tolist()) if s > 0)[:top]
        assert [(-s, d) for s, d in lexical.best_documents(shard, asked, often, top, at_once=at_once)] == want


def test_long_texts_are_cut_piece_by_piece():
    text = "Ab cD-é, " * 300 + "z" * 3000
    for most in (1, 10, 1000, 1 << 20):
        assert lexical.term_counts(text.encode(), most) == {b"ab": 300, b"cd": 300, "é".encode(): 300, b"z" * 3000: 1}


def test_figures_beyond_64_bits():
    n = np.array([10 ** 9, 5], np.int64)
    got = lexical.part(np.array([3, 1], np.int64), n, 10 ** 12, 10 ** 15)
    assert got.tolist() == [10 ** 9 * t // (1000 * t + 12 * (75 + 25 * int(k) * 10 ** 12 // 10 ** 15)) for t, k in ((3, n[0]), (1, n[1]))]
