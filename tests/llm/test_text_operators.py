"""Tokenizers, license scan, HTML extraction: against public libraries, brute force, and edge cases."""

import base64
import hashlib
import random
import textwrap

import public_tokenizers
import pytest
import tiktoken

from basketlens.llm import byte_bpe, html_text, licenses, wordpiece

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
EDGE = [(1, None), (2, ""), (3, " \t\n "), (None, "null id"), (5, "again"), (5, "again"), (6, "x" * 30_000),
        (7, "é ñ 中文 🙂\x1c\x85 a\r\n\n  b")]


@pytest.fixture(scope="module")
def edge(spark):
    """Edge cases, with further columns whose names clash with those of results."""
    return spark.createDataFrame([(i, t, "en", 1, "z") for i, t in EDGE],
                                 "doc_id long, text string, lang string, n_tokens int, license string")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


@pytest.fixture(scope="module")
def public():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.loaded(byte_bpe.read_ranks(RANKS), public_tokenizers.PATTERN)


def test_bpe_equals_the_public_encoder(bpe, public):
    draw = random.Random(1)
    for letters in ("ab", "abc de", "éèñ ß", "the an in ion ", "中文字 ", "0123 45,.\n\t \x1c\x85  ", "🙂🙃👍 "):
        for size in (1, 3, 10, 50, 700):
            for _ in range(20):
                text = "".join(draw.choice(letters) for _ in range(size))
                assert bpe.encode(text) == public.encode_ordinary(text)
                assert bpe.decode(bpe.encode(text)) == text.encode()


def test_bpe_takes_every_character_as_the_public_encoder(bpe, public):
    for code in [*range(0x3000), *range(0xA000, 0xB000), *range(0x1F000, 0x1F700), 0x2028, 0x3000, 0xFEFF, 0x10FFFF]:
        text = f"a{chr(code)}1 {chr(code)} {chr(code)}b"
        assert bpe.encode(text) == public.encode_ordinary(text), hex(code)


def test_bpe_long_pieces(bpe, public):
    draw = random.Random(3)
    for text in ("a" * 5000, "".join(draw.choice("abcdefgh") for _ in range(5000)), " " * 3000 + "x"):
        assert bpe.encode(text) == public.encode_ordinary(text)


def test_bpe_report_edge_cases(edge, empty, public):
    rows = byte_bpe.round_trip_report(edge, RANKS, public_tokenizers.PATTERN).collect()
    want = []
    for i, text in EDGE:
        ids = public.encode_ordinary(text or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, rows), key=repr) == sorted(want, key=repr)
    assert byte_bpe.round_trip_report(empty, RANKS, public_tokenizers.PATTERN).count() == 0


def test_bpe_encode_and_decode_are_frames(edge):
    encoded = byte_bpe.encode(edge, RANKS, public_tokenizers.PATTERN)
    decoded = byte_bpe.decode(encoded, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted(bytes(r.content).decode() for r in decoded) == sorted(t or "" for _, t in EDGE)


def longest_match(vocabulary, word, marker):
    text, at, n = marker + word, 0, 0
    while at < len(text):
        for end in range(len(text), at, -1):
            if text[at:end] in vocabulary and (at or text[at:end].startswith(marker)):
                break
        else:
            return 1
        at, n = end, n + 1
    return n


def test_wordpiece_equals_longest_match():
    draw = random.Random(0)
    some = lambda least, most: bytes(draw.choice(b"abc") for _ in range(draw.randint(least, most)))
    for _ in range(500):
        vocabulary = {some(1, 5) for _ in range(draw.randint(1, 12))} | {b"_" + some(0, 4) for _ in range(draw.randint(0, 8))}
        matcher = wordpiece.Matcher(sorted(vocabulary), b"_")
        for _ in range(20):
            word = some(1, 12)
            assert matcher.count(word) == longest_match(vocabulary, word, b"_"), (vocabulary, word)


def test_wordpiece_counts_edge_cases(edge, empty, spark):
    vocabulary = {base64.b64decode(line.split()[0]) for line in open(RANKS, "rb")}
    want = [(i, len((t or "").encode().split()),
             sum(longest_match(vocabulary, w, b" ") for w in (t or "").encode().split() if len(w) < 1000))
            for i, t in EDGE if len(t or "") < 1000]
    got = [tuple(r) for r in wordpiece.token_counts(edge, RANKS).collect() if r.doc_id != 6]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert wordpiece.token_counts(empty, RANKS).count() == 0
    sample = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").limit(25)
    texts = {r.doc_id: r.text for r in sample.collect()}
    for row in wordpiece.token_counts(sample, RANKS).collect():
        assert row.n_tokens == sum(longest_match(vocabulary, w, b" ") for w in texts[row.doc_id].encode().split())


NOTICES = {wording: (name, i) for i, (name, wording) in enumerate(licenses.TEMPLATES)}


def test_licenses_found_as_planted(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = sorted((r.doc_id, at, name) for r in docs.collect() for wording, (name, _) in NOTICES.items()
                  for line, at in lines(r.text) if line == wording)
    got = sorted((r.doc_id, r.start, r.license) for r in licenses.scan_licenses(docs).where("n_different = 0").collect())
    assert got == want and want


def lines(text):
    at = 0
    for line in text.split("\n"):
        yield line, at
        at += len(line) + 1


def test_licenses_wording():
    scan = licenses.Scanner(licenses.TEMPLATES).scan
    for wording, (name, _) in NOTICES.items():
        found = scan("Some words before.\n" + wording + "\nand some after it")
        assert [(n.license, n.n_different) for n in found] == [(name, 0)], wording
    mit = licenses.TEMPLATES[1][1]
    (near,) = scan(mit.replace("free of charge", "free of any charge"))
    assert (near.license, near.n_different, near.wording) == ("MIT", 1, "+any")
    assert [n.license for n in scan("Released under the MIT License. Licensed under CC BY 4.0.")] == ["MIT", "CC-BY-4.0"]
    assert scan("a license to kill") == [] == scan("") == scan("licensed under the GNU General Public License, version 7.")
    deep = "x " * 3000 + "Released under the MIT License." + " y" * 3000
    assert [(n.license, n.start) for n in scan(deep)] == [("MIT", 6000)]
    across = "z" * 585 + " Licensed under the Apache License, Version 2.0. " + "w" * 900
    assert [n.license for n in scan(across)] == ["Apache-2.0"]


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// "])
def test_licenses_wrapped_over_lines(mark):
    scan = licenses.Scanner(licenses.TEMPLATES).scan
    for wording, (name, _) in NOTICES.items():
        for width in (72, 30):
            wrapped = "\n".join(mark + line for line in textwrap.wrap(wording, width))
            text = "Some words before.\n" + mark + "\n" + wrapped + "\n" + mark + "\nand some after it"
            assert [(n.license, n.n_different) for n in scan(text)] == [(name, 0)], (wording, width)
    whole = "\n\n".join("\n".join(mark + line for line in textwrap.wrap(w, 72)) for w in NOTICES)
    opening = next(w for w in NOTICES if w.startswith("Redistribution"))  # the clause of another license follows it here
    assert [n.license for n in scan(whole)] == ["BSD-3-Clause" if w == opening else name for w, (name, _) in NOTICES.items()]


BSD = ("Copyright (c) 2020, Somebody. All rights reserved.\n\nRedistribution and use in source and binary forms, with or without "
       "modification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must "
       "retain the above copyright notice, this list of conditions and the following disclaimer.\n2. Redistributions in binary "
       "form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
       "documentation and/or other materials provided with the distribution.\n")
THIRD = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
         "derived from this software without specific prior written permission.\n")


def test_licenses_told_apart_by_their_clauses():
    scan = licenses.Scanner(licenses.TEMPLATES).scan
    assert {n.license for n in scan(BSD)} == {"BSD-2-Clause"} and {n.license for n in scan(BSD + THIRD)} == {"BSD-3-Clause"}
    assert [n.license for n in scan(BSD + BSD + THIRD)] == ["BSD-2-Clause", "BSD-3-Clause", "BSD-3-Clause"]
    for text, name in (("# SPDX-License-Identifier: MIT\nimport os", "MIT"), ("/* SPDX-License-Identifier: GPL-2.0-only */", "GPL-2.0-only"),
                       ("// SPDX-License-Identifier: LGPL-2.1-or-later", "LGPL-2.1-or-later"), ("Licensed under the MIT license", "MIT"),
                       ("This work is licensed under the GNU General Public License, version 3.0", "GPL-3.0")):
        assert [(n.license, n.n_different) for n in scan(text)] == [(name, 0)], text


def test_licenses_near_wordings_equal_a_search_of_all_places():
    """Against word distances of every long template at every place of texts with a few changed words."""
    draw, scanner = random.Random(3), licenses.Scanner(licenses.TEMPLATES)
    long = [i for i, (_, want) in enumerate(scanner.templates) if len(want) >= 20]

    def distance(a, b):
        """Words to take out and put in."""
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            before, row = row, [i + 1]
            for j, y in enumerate(b):
                row.append(before[j] if x == y else 1 + min(before[j + 1], row[j]))
        return row[-1]
    for _ in range(40):
        want = scanner.templates[draw.choice(long)][1]
        changed = list(want)
        for _ in range(draw.randint(0, licenses.may_differ(want) // 2 + 1)):
            at = draw.choice([i for i, w in enumerate(want) if not any(c.isdigit() for c in w)])  # numbers must not differ
            changed[at] = draw.choice(["somehow", "elsewhere", "perhaps"])
        have = ["before"] * draw.randrange(5) + changed + ["after"] * draw.randrange(5)
        fits = {}
        for i in long:
            whole = scanner.templates[i][1]
            near = min(distance(whole, have[a:a + n]) for n in range(len(whole) - 2, len(whole) + 3)
                       for a in range(max(1, len(have) - n + 1)))
            if near <= licenses.may_differ(whole):
                fits[scanner.templates[i][0]] = min(near, fits.get(scanner.templates[i][0], 99))
        found = scanner.scan(" ".join(have))
        found = [n for n in found if n.n_words >= 20]
        assert {n.license for n in found} <= set(fits) and bool(found) == bool(fits)
        assert all(n.n_different == fits[n.license] for n in found)


def test_licenses_of_other_templates(spark):
    docs = spark.createDataFrame([(1, "So: do what\nyou please with this."), (2, "License")], "doc_id long, text string")
    rows = licenses.scan_licenses(docs, [("Any", "Do what you please with this.")]).collect()
    assert [(r.doc_id, r.start, r.license) for r in rows] == [(1, 4, "Any")]


def test_licenses_edge_cases(edge, empty):
    assert licenses.scan_licenses(edge).count() == 0 == licenses.scan_licenses(empty).count()
    twice = edge.sparkSession.createDataFrame([(None, "Released under the MIT License.\n" * 2)] * 2, "doc_id long, text string")
    assert [r.start for r in licenses.scan_licenses(twice).orderBy("start").collect()] == [0, 0, 32, 32]


PAGES = [
    ("<html><head><title>T</title></head><body><nav><a>Home</a></nav><article><h1>Head</h1><p>One &amp; two,"
     " <b>three</b>four.<br>five<p>Six\n seven</p></article><footer>&copy; x</footer></body></html>",
     "Head One & two, threefour. five Six seven"),
    ("<body><div class='menu'><a>Home</a></div><div id=content><h2>Title here</h2><p>A long text, with commas. And more"
     " of it; so it goes on.<p>Second one.<ul><li>one<li>two</ul><div class=\"comments\"><p>I hate this, really, and so on"
     "</p></div></div><div class='sidebar'>junk</div>",
     "Title here A long text, with commas. And more of it; so it goes on. Second one. one two"),
    ("<article>a &lt; b <!-- no --><script>if (a<b) x('</p>')</script><form>Name <input></form> and <3 <b>bold</article>t",
     "a < b and <3 bold"),
    ("<article>cut off <a hre", "cut off"), ("plain", "plain"), ("", ""), (None, ""), ("<p>", ""), ("<nav>only menu</nav>", ""),
    ("<main><p class='notice'>Cookies!</p><p>Text, indeed.</p><aside>more</aside></main>", "Text, indeed."),
    ("<article><h1>A</h1></article>", "A"),
    ("<article><p>The story, told at length; it goes on and on.</p><section><h2>Reader voices</h2><article><p>I love it, says Bob"
     "</p></article><article><p>Me too.</p></article></section></article>", "The story, told at length; it goes on and on."),
    ("<article><h1>Head</h1><p>The story, told at length; it goes on.</p><article><p>Short, says Bob</p></article></article>",
     "Head The story, told at length; it goes on."),
    ("<article><h1>All</h1><article><p>The story itself, in an article of its own; it goes on.</p></article></article>",
     "All The story itself, in an article of its own; it goes on."),
    ("<div class=post><p>The story, told at length; it goes on and on.</p></div><div><a>Home</a><a>About</a></div>",
     "The story, told at length; it goes on and on."),
    ("<div><p>The story, told at length; see <a>this one</a> and <a>that</a>, too.</p></div><ul><li><a>One</a><li><a>Two</a></ul>",
     "The story, told at length; see this one and that, too."),
    ("<article><div class=\"entry-header\"><h1>Head</h1></div><p>Text, of course.</p><ul><li><a>Source</a></ul></article>"
     "<div class=site-header>x</div>", "Head Text, of course. Source"),
]


@pytest.mark.parametrize("page, text", PAGES)
def test_main_text(page, text):
    assert html_text.main_text(page) == text


def test_ratios_select_and_names_only_weigh():
    prose = " ".join(f"<p>Sentence {i} of the body, which is long; it has commas, and it goes on and on.</p>" for i in range(6))
    plain = " ".join(f"Sentence {i} of the body, which is long; it has commas, and it goes on and on." for i in range(6))
    for page in (f"<body><div id=page><div>{prose}</div></div><section><article><a>More news</a></article></section></body>",
                 f"<body><div class='form page'><article>{prose}</article></div><footer>x</footer></body>",
                 f"<body><article>{prose}</article><article class='comment'><p>I hate this, really, and so on.</p></article>"
                 "<article class='related'>Read this, too</article></body>"):
        assert html_text.main_text(page) == plain


def test_pages_as_planted(spark):
    """Against the plain cut between the article tags, which these pages all have."""
    import html
    import re
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    rows = html_text.extract(pages).collect()
    assert len(rows) == len(source)
    for row in rows:
        inner = re.search(r"<article>(.*?)(</article>|\Z)", source[row.page_id], re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", inner.replace("<br>", " ")))
        assert row.text == " ".join(" ".join(html.unescape(b).split()) for b in blocks if b.strip())
        assert row.n_chars == len(row.text)


ELEMENTS = [("<div>", "</div>"), ('<div class="post">', "</div>"), ('<section class="story">', "</section>"),
            ("<div id=c><div class=inner>", "</div></div>"), ("<main>", "</main>"), ("", "")]


@pytest.mark.parametrize("opened, closed", ELEMENTS)
def test_pages_without_an_article_element(spark, opened, closed):
    """The same pages with other elements in place of the article, and a menu and comments after it."""
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    menu = '<div><a href="/">Home</a> <a href="/b">About</a></div><div class="comments"><p>Well, I never.</p></div>' if opened else ""
    for page in pages:
        other = page.replace("<article>", opened).replace("</article>", closed).replace("</footer>", "</footer>" + menu)
        assert html_text.main_text(other) == html_text.main_text(page)


def test_pages_edge_cases(spark):
    frame = spark.createDataFrame([(1, None, None, "a"), (1, "u", "<p>x", "b"), (None, "v", "<p>x", "c")],
                                  "page_id long, url string, html string, text string")
    assert sorted(map(tuple, html_text.extract(frame).collect()), key=repr) == [
        (1, "u", "x", 1), (1, None, "", 0), (None, "v", "x", 1)]
    assert html_text.extract(frame.limit(0)).count() == 0


def test_deep_and_long_pages():
    assert html_text.main_text("<div>" * 5000 + "deep text, here.") == "deep text, here."
    assert len(html_text.main_text("<article>" + "<p>word, word." * 20_000).split()) == 40_000
