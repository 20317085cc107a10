"""Spelling groups against edit distances of all pairs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from basketlens.llm import spelling


def near(u, v):
    """One inserted, deleted or replaced letter apart."""
    if len(u) > len(v):
        u, v = v, u
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    return len(v) == len(u) + 1 and any(v[:i] + v[i + 1:] == u for i in range(len(v)))


def brute(rows):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    forms, out = {}, []
    for w in n:
        others = sorted((v for v in n if near(w, v)), key=lambda v: (-n[v], v))
        forms[w] = others[0] if others and n[others[0]] >= 5 * n[w] else None, len(others)
    for w in n:
        root = w
        while forms[root][0]:
            root = forms[root][0]
        out.append((w, forms[w][0], root, n[w], forms[w][1], n.get(forms[w][0])))
    return sorted(out)


def found(spark, rows, **how):
    df = spark.createDataFrame([(*r, "x", 1, 2, "y", "z") for r in rows],
                               "doc_id long, text string, word string, n int, cell int, root string, best string")
    return sorted(map(tuple, spelling.spelling_groups(df.repartition(3), **how).collect()))


def varied(draw, bases, letters):
    words = []
    for _ in range(bases):
        base = "".join(draw.choice(letters) for _ in range(draw.choice([5, 6, 7, 8, 12])))
        words += [base] * draw.choice([5, 30, 700])
        for _ in range(draw.randint(0, 6)):
            at, how, c = draw.randrange(len(base)), draw.random(), draw.choice(letters)
            other = base[:at] + (c if how < 0.7 else "") + base[at + (how < 0.4 or how >= 0.7):]
            words += [other] * draw.choice([4, 5, 6, 27, 140])
            if draw.random() < 0.5:
                words += [other[:-1] + c] * draw.choice([5, 6])
    draw.shuffle(words)
    return words


@pytest.mark.parametrize("how", [{}, {"cell": 8, "sample": 100, "asked": 16}, {"cell": 30, "sample": 1000, "asked": 5}])
def test_groups_equal_brute_force(spark, how):
    draw = random.Random(13)
    words = varied(draw, 120, "abcdeé") + varied(draw, 30, "xyÿÀ×÷Z")
    rows = [(i, draw.choice([" ", "-", "1", "Δ", "\n"]).join(words[i * 40:i * 40 + 40])) for i in range(len(words) // 40 + 1)]
    rows += [(9000, None), (9001, ""), (None, "letters " * 7), (None, "letter " * 50), (9002, "letters " * 3), (9002, "letters " * 3)]
    want = brute(rows)
    assert sum(w[1] is not None for w in want) > 30 and any(w[2] not in (w[0], w[1]) for w in want)
    assert found(spark, rows, **how) == want


def test_dropped_letters(spark):
    # One row in 199 loses a letter, so a common word makes variants of its own.
    rows = [(i, "Understanding, understanding") for i in range(20000)] + [(i, "ab") for i in range(400)]
    want = brute(rows)
    assert len(want) > 3 and found(spark, rows) == want


def test_no_words(spark):
    assert found(spark, []) == [] and found(spark, [(1, "short words only"), (2, "seldom")]) == []


def test_anagrams_fill_a_cell_that_cannot_be_cut(spark):
    draw, words = random.Random(1), set()
    while len(words) < 300:
        words.add("".join(draw.sample("abcdefgh", 8)))
    words |= {w[:3] + "z" + w[4:] for w in list(words)[:50]} | {w[:5] + w[6:] for w in list(words)[:50]}
    rows = [(i, " ".join(sorted(words))) for i in range(6)]
    assert found(spark, rows, cell=16, sample=1000, asked=64) == brute(rows)


def test_near_pairs_equal_all_pairs():
    draw = random.Random(7)
    short, long = ([w for w in {"".join(draw.choice("abc") for _ in range(n)) for _ in range(400)}] for n in (6, 7))
    for asked, held in ((short, short), (short, long)):
        a, b = spelling.near_pairs(*(spelling.letters(x, len(x[0])) for x in (asked, held)), leaf_size=4)
        assert sorted((asked[i], held[j]) for i, j in zip(a, b)) == sorted((u, v) for u in asked for v in held if near(u, v))


def test_very_long_words(spark):
    long = "ab" * 60_000
    rows = [(i, f"{long} {long[:-1]} {long}x") for i in range(6)] + [(i, long) for i in range(10, 40)]
    got, want = found(spark, rows), brute(rows)
    assert got == want and len(got) >= 3
    assert spelling.words_of("Abc déf " * 100 + "x" * 5000, most=7) == {b"abc": 100, "déf".encode("latin-1"): 100, b"x" * 5000: 1}


def test_letter_counts():
    got = spelling.letter_counts(spelling.letters(["abca", "zÿÀa"], 4))
    assert got.shape == (2, 90) and got[0, :3].tolist() == [2, 1, 1] and np.flatnonzero(got[1]).tolist() == [0, 25, 26, 89]


def test_registered_query_equals_brute_force(spark):
    from basketlens.llm import queries
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert sorted(map(tuple, queries.op13_spelling_variants(spark, folder).collect())) == brute(rows)
