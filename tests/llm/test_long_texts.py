"""Texts of some megabytes among short ones: each operator reads them whole."""

import hashlib
import random

import pytest
from test_dedup_operators import brute_components, brute_cut

from basketlens.llm import exact_dedup, html_text, lexical, licenses, packing, shingle_join, simhash, spelling, substring_dedup

PASSAGE = " ".join(f"p{i}" for i in range(60))


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(21)
    long = " ".join(f"{draw.choice('abcdefgh')}{draw.randrange(30_000)}" for _ in range(250_000))
    other = " ".join(f"{draw.choice('abcdefgh')}{draw.randrange(30_000)}" for _ in range(100_000))
    return [(1, long + " " + PASSAGE), (2, "x " + PASSAGE + " y"), (3, other), (4, other.replace("a", "q", 3)), (5, "short text"), (6, other)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, f"s{i}") for i, t in rows], "doc_id long, text string, source string").repartition(3)


def test_substring_dedup(docs, rows):
    got = sorted(map(tuple, substring_dedup.cut_repeats(docs).collect()))
    assert got == brute_cut(rows, 35) and dict((r[0], r[2]) for r in got)[1] == 60


def test_shingle_join(docs, rows):
    got = shingle_join.similar_components(docs, 90, 3).collect()
    assert sorted(map(tuple, got), key=repr) == brute_components(rows, 90, 3)
    assert {r.doc_id: r.component_id for r in got}[4] == 3


def test_exact_dedup(docs, rows):
    got = {r.doc_id: (r.keep_id, r.text_sha256) for r in exact_dedup.exact_dedup_report(docs).collect()}
    assert got == {i: (6 if i == 3 else i, hashlib.sha256(t.lower().encode()).hexdigest()) for i, t in rows}


def test_packing(docs, rows):
    got = packing.pack(docs, words=True).collect()
    pieces = {i: [r for r in sorted(got, key=lambda r: r.piece) if r.doc_id == i] for i, _ in rows}
    for i, text in rows:
        assert " ".join(p.text for p in pieces[i]).split() == text.split()
    bins = [r.bin for r in got]
    assert len(bins) == len({(r.bin, r.start) for r in got}) and all(r.start + r.length <= packing.CAPACITY for r in got)


def test_licenses_at_the_end(spark, rows):
    text = rows[0][1] + "\nReleased under the MIT License."
    got = licenses.scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert [(r.license, r.start) for r in got] == [("MIT", len(rows[0][1]) + 1)]


def test_simhash_and_search_and_spelling(spark, docs, rows):
    prints = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    assert prints[1].fingerprint == f"{simhash.fingerprint(rows[0][1].encode(), most=1 << 30) % 2 ** 64:016x}"
    assert prints[6].component_id == prints[3].component_id == prints[4].component_id == 3
    found = lexical.search(docs, spark.createDataFrame([(1, "p59"), (2, "short")], "item_id long, text string")).collect()
    assert sorted((r.item_id, r.doc_id) for r in found) == [(1, 1), (1, 2), (2, 5)]
    words = spark.createDataFrame([(1, "spelling " * 200_000 + "speling " * 9)], "doc_id long, text string")
    assert {r.word: r.form for r in spelling.spelling_groups(words).collect()}.get("speling") == "spelling"


def test_html(rows):
    page = f"<body><nav>menu</nav><article><p>{rows[2][1]}</p><p>{PASSAGE}</p></article></body>"
    assert html_text.main_text(page) == rows[2][1] + " " + PASSAGE
