"""Exact, near and substring dedup against brute force, with caps so small that spills and tiles are used."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlens.llm import exact_dedup, graph, shingle_join, substring_dedup
from basketlens.llm.common import prepare, word_hashes

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
NOTHING = [(900, None), (901, ""), (902, " \t\n"), (None, "a b"), (None, "a b"), (903, "a b"), (904, "Ab\x1cB")]


def frame(spark, rows):
    """Rows in several partitions, with further columns whose names clash with those of results."""
    schema = "doc_id long, text string, keep_id string, digest int, id int, n int, grp string, mark int, start int"
    return spark.createDataFrame([(*r, "x", 1, 2, 3, "g", 4, 5) for r in rows], schema).repartition(3)


def edited(draw, groups=60, letters="abcdefghijklmnop", sizes=(1, 2, 3, 5, 8, 12, 20, 40, 90, 300)):
    rows = []
    for _ in range(groups):
        base = [draw.choice(letters) * draw.randint(1, 3) for _ in range(draw.choice(sizes))]
        for _ in range(draw.randint(1, 8)):
            words = list(base)
            for _ in range(draw.choice([0, 0, 1, 1, 2, 3])):
                how, at = draw.random(), draw.randrange(len(words)) if words else 0
                if how < 0.4 and words:
                    words[at] = f"new{draw.randrange(50)}"
                elif how < 0.7 and words:
                    del words[at]
                else:
                    words.insert(at, f"ins{draw.randrange(50)}")
            rows.append((len(rows), draw.choice([" ", "  ", "\n"]).join(words)))
    return rows


def test_exact_groups_with_spills(spark):
    draw = random.Random(4)
    texts = ["".join(draw.choice("aAbB é\n") for _ in range(draw.choice([0, 1, 2, 50, 3000]))) for _ in range(60)]
    rows = [(i, draw.choice(texts + [texts[7]] * 30)) for i in range(400)] + NOTHING
    groups = {}
    for i, text in rows:
        groups.setdefault((text or "").encode().lower(), []).append(i)
    want = []
    for i, text in rows:
        group = groups[(text or "").encode().lower()]
        want.append((i, hashlib.sha256((text or "").encode().lower()).hexdigest(), len(group),
                     max((g for g in group if g is not None), default=None)))
    for table_bytes in (64 << 20, 4000):
        got = exact_dedup.exact_groups(frame(spark, rows), table_bytes=table_bytes).collect()
        assert sorted(((r.doc_id, bytes(r.digest).hex(), r.group_size, r.keep_id) for r in got), key=repr) == sorted(want, key=repr)


def test_grace_spills_and_compares_content(tmp_path):
    same = b"d" * 32  # one digest for all: only complete content tells the texts apart
    records = [(same, b"%d" % (i % 7), 1, i) for i in range(50)]
    got = sorted(tuple(r) for r in exact_dedup.grace(records, 300, str(tmp_path)))
    assert got == sorted((same, b"%d" % k, len(range(k, 50, 7)), max(range(k, 50, 7))) for k in range(7))
    assert not any(p.is_file() for p in tmp_path.rglob("*"))


def test_drop_copies_keeps_rows_and_columns(spark):
    docs = frame(spark, [(1, "Same"), (2, "sAME"), (3, "other"), (4, None), (5, "")])
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 5]
    assert exact_dedup.exact_dedup_report(docs.limit(0)).count() == 0


def test_one_row_for_each_text(spark):
    """Repeated rows, null ids, one id with two texts: each text has one row, that of its largest id."""
    rows = [(1, "a b")] * 3 + [(2, "A b")] * 2 + [(7, "c"), (7, "d"), (8, "d"), (9, "c"), (9, "e")]
    rows += [(None, "d"), (None, "f"), (None, "f"), (None, "g"), (None, None), (None, ""), (4, "h"), (4, "H")]
    want = [(2, "a b"), (8, "d"), (9, "c"), (9, "e"), (None, "f"), (None, "g"), (None, ""), (4, "h")]
    got = exact_dedup.drop_copies(frame(spark, rows)).collect()
    assert sorted([(r.doc_id, (r.text or "").lower()) for r in got], key=repr) == sorted(want, key=repr)


def test_one_row_for_each_component(spark):
    a, b, c, d, e = (" ".join(f"{x}{i}" for i in range(100)) for x in "abcde")
    rows = [(1, a)] * 3 + [(1, a + " z"), (2, a)] + [(5, b), (5, c), (3, c), (5, d)]  # id 5 leads b and d, not c
    rows += [(None, a), (None, e), (None, e), (None, e + " z"), (None, " "), (None, ""), (6, ""), (6, " ")]
    kept = shingle_join.one_of_each(frame(spark, rows)).collect()
    assert sorted([(r.doc_id, r.text[:1].strip()) for r in kept], key=repr) == sorted(
        [(1, "a"), (5, "b"), (3, "c"), (5, "d"), (None, "e"), (None, ""), (None, ""), (6, ""), (6, "")], key=repr)


def brute_components(rows, percent, width):
    """(id, shingles, least id of the component, links)"""
    sets = []
    for _, text in rows:
        words = WORD.findall((text or "").encode().lower())
        sets.append({tuple(words[k:k + width]) for k in range(max(1, len(words) - width + 1))} if words else set())
    label, links = list(range(len(rows))), [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                links[i] += 1
                links[j] += 1
                if label[i] != label[j]:
                    old, new = label[i], label[j]
                    label = [new if x == old else x for x in label]
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[label[k]] = min(least.get(label[k], i), i)
    return sorted(((i, len(sets[k]), least.get(label[k]), links[k]) for k, (i, _) in enumerate(rows)), key=repr)


@pytest.mark.parametrize("percent, width, block", [(90, 3, 2048), (80, 5, 4), (80, 3, 3)])
def test_shingle_components(spark, percent, width, block):
    rows = edited(random.Random(5)) + NOTHING
    got = shingle_join.similar_components(frame(spark, rows), percent, width, block=block, frequent=3 * block).collect()
    assert sorted(map(tuple, got), key=repr) == brute_components(rows, percent, width)


def test_shingle_join_of_one_large_group(spark):
    """Near copies that differ in one of two hundred words, around one text: all connected, none emitted in pairs."""
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(base[:i] + [f"other{i}"] + base[i + 1:])) for i in range(150)] + [(500, "something else entirely")]
    got = shingle_join.similar_components(frame(spark, rows), 90, 3, block=16, frequent=4).collect()
    assert {r.component_id for r in got} == {0, 500}
    assert sorted((r.doc_id, r.n_links) for r in got) == [(i, 149) for i in range(150)] + [(500, 0)]
    kept = shingle_join.one_of_each(frame(spark, rows), 90, 3)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 500]


def test_shingle_join_without_rows(spark):
    assert shingle_join.similar_components(frame(spark, [(1, "a")]).limit(0)).count() == 0
    assert shingle_join.similar_components(frame(spark, NOTHING[:3])).count() == 3


def test_null_ids_cost_no_more_than_ids(spark):
    """Near copies with null ids: each is found by its text, not by all texts without an id."""
    base = [f"w{i}" for i in range(60)]
    rows = [(None, " ".join(base[:i % 60] + [f"other{i}"] + base[i % 60 + 1:])) for i in range(400)] + [(None, " ".join(base))] * 30
    got = shingle_join.similar_components(frame(spark, rows), 80, 3).collect()
    assert sorted(map(tuple, got), key=repr) == brute_components(rows, 80, 3)


def test_columns_of_any_name_are_kept(spark):
    columns = ["doc_id", "text", "of_id", "of_digest", "__id", "__digest", "kept_id", "times", "digest", "id"]
    docs = spark.createDataFrame([(i, t, *"abcdefgh") for i, t in enumerate(["a b", "A b", "c", "c"])], columns)
    for kept, ids in ((exact_dedup.drop_copies(docs), [1, 3]), (shingle_join.one_of_each(docs), [0, 2])):
        assert kept.columns == columns and [tuple(r)[2:] for r in kept.collect()] == [tuple("abcdefgh")] * 2
        assert sorted(r.doc_id for r in kept.collect()) == ids


def test_shingles_that_agree_in_half_their_bits_are_told_apart():
    values = np.array([[5, 1], [7, 0], [5, 2], [5, 1]], np.uint64)
    number = shingle_join.numbered(values)
    assert number[0] == number[3] and len(set(number.tolist())) == 3


def test_word_hashes_tell_words_apart_and_find_them_again():
    draw = random.Random(2)
    words = sorted({bytes(draw.choice(b"ab\x00") for _ in range(draw.choice([1, 2, 7, 8, 9, 16, 17, 255, 256, 257, 700]))) for _ in range(3000)})
    data, ends = np.frombuffer(b" ".join(words), np.uint8), np.cumsum([len(w) + 1 for w in words]) - 1
    got = word_hashes(data, ends - [len(w) for w in words], ends)
    assert len({tuple(h) for h in got}) == len(words) and len(set(got[:, 0].tolist())) == len(set(got[:, 1].tolist())) == len(words)
    for i in range(0, len(words), 97):
        alone = np.frombuffer(words[i], np.uint8)
        assert (word_hashes(alone, np.array([0]), np.array([len(alone)]))[0] == got[i]).all()


def test_bands_leave_enough_parts():
    for percent in (80, 90):
        known = shingle_join.bands(percent, 5000)
        assert all(a.high == b.low for a, b in zip(known, known[1:]))
        for band in known:
            for small in {band.low, band.high - 1}:
                large = 100 * small // percent
                assert band.parts - (small + large) * (100 - percent) // (100 + percent) > band.spare


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (201, 200), (201, 200)]
    got = dict(map(tuple, graph.components(spark.createDataFrame(chain, "a long, b long"), "test").collect()))
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(50)}, 200: 200, 201: 200}
    assert graph.components(spark.createDataFrame([], "a long, b long"), "test").count() == 0


def brute_cut(rows, window):
    split = [[w.decode() for w in WORD.findall((text or "").encode())] for _, text in rows]
    seen = {}
    for words in split:
        for k in range(len(words) - window + 1):
            key = tuple(words[k:k + window])
            seen[key] = seen.get(key, 0) + 1
    out = []
    for (i, _), words in zip(rows, split):
        gone = set()
        for k in range(len(words) - window + 1):
            if seen[tuple(words[k:k + window])] > 1:
                gone.update(range(k, k + window))
        out.append((i, len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window, kmer", [(6, 2), (5, 5), (35, 11)])
def test_substrings(spark, window, kmer):
    draw = random.Random(window)
    rows = edited(draw, 40, "abc") + edited(draw, 25, "ab", (10, 60, 150))
    shared = " ".join(f"s{i}" for i in range(80))
    rows += [(0, f"x{i} {shared} y{i}") for i in range(3)]  # one passage, one id, three texts
    rows += [(0, "a"), (0, "again and " * 40), (1, "again and " * 40), (1, "again and " * 40)] + NOTHING
    got = substring_dedup.cut_repeats(frame(spark, rows), window=window, kmer=kmer).collect()
    assert sorted(map(tuple, got), key=repr) == brute_cut(rows, window)


def thue_morse(n, a, b):
    """Words in the order in which sums of powers of any odd number modulo 2**64 can't tell a from b."""
    return [(a, b)[i.bit_count() & 1] for i in range(n)]


def test_words_and_windows_of_like_structure_differ(spark):
    words = ["".join(thue_morse(2048, *ab)) for ab in ("ab", "ba")]
    rows = [(i, " ".join([w] + ["same"] * 34)) for i, w in enumerate(words)]
    rows += [(2 + i, " ".join(thue_morse(4096, *ab))) for i, ab in enumerate((("x", "y"), ("y", "x")))]
    got = substring_dedup.cut_repeats(frame(spark, rows)).collect()
    assert sorted(map(tuple, got), key=repr) == brute_cut(rows, 35) and [r.n_removed for r in got if r.doc_id < 2] == [0, 0]
    long = substring_dedup.cut_repeats(frame(spark, rows[2:]), window=2100, kmer=11).collect()
    assert sorted(map(tuple, long), key=repr) == brute_cut(rows[2:], 2100)
    alone = [(i, w) for i, w in enumerate(words)]
    got = shingle_join.similar_components(frame(spark, alone + [(5, words[0].upper())]), 90, 3).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(0, 0), (1, 1), (5, 0)]


def test_paths_of_the_graph(spark):
    """A passage that two texts share: runs inside it are edges as a whole, windows at its ends single ones."""
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(["a"] + words + ["b"])), (2, " ".join(["c"] + words + ["d"]))]
    prepare(spark)
    keyed = substring_dedup.keyed(F.col("text"), frame(spark, rows))
    places, edges = substring_dedup.repeated_edges(keyed, 10, 3)
    occurs = places.join(edges.select("e1", "e2"), ["e1", "e2"]).distinct()
    assert edges.agg(F.sum("windows")).head()[0] == 51 and occurs.agg(F.sum("windows")).head()[0] == 102
    paths = substring_dedup.compacted(edges)
    assert paths.count() == edges.count() > 5 and paths.select("of1", "of2", "begins").distinct().count() <= 3
    spans = substring_dedup.repeated_spans(keyed, 10, 3).collect()
    assert len(spans) <= 6 and min(s.start for s in spans) == 1 and max(s.end for s in spans) == 61
    sources = {(s.of1, s.of2, s.at, s.end - s.start) for s in spans}
    assert len(sources) <= 3  # both texts lead to the same source coordinates


def test_branching_nodes_end_paths(spark):
    """Two passages that meet in the middle: what follows the common part differs, so no path goes on across it."""
    left, mid, right = ([f"{x}{i}" for i in range(30)] for x in "lmr")
    rows = [(i, " ".join(w)) for i, w in enumerate([left + mid, left + mid, mid + right, mid + right, ["x"] + mid[:15]])]
    prepare(spark)
    keyed = substring_dedup.keyed(F.col("text"), frame(spark, rows))
    _, edges = substring_dedup.repeated_edges(keyed, 8, 8)
    got = edges.join(substring_dedup.compacted(edges), ["e1", "e2"]).collect()
    reached = {}
    for r in got:
        reached.setdefault((r.of1, r.of2, r.begins), []).append((r.place, r.windows, r.tail, r.head))
    tails, heads = [r["tail"] for r in got], [r["head"] for r in got]
    for steps in reached.values():
        steps.sort()
        for (place, windows, _, head), (after, _, tail, _) in zip(steps, steps[1:]):
            assert place + windows == after and head == tail and tails.count(tail) == heads.count(head) == 1


def test_spans_that_differ_from_their_source_end_the_job(spark):
    checks = [(1, 2, 3, 40, b"one"), (1, 2, 3, 40, b"one"), (1, 2, 9, 40, b"two")]
    schema = "of1 long, of2 long, at int, words int, digest binary"
    substring_dedup.verify(spark.createDataFrame(checks, schema))
    with pytest.raises(RuntimeError):
        substring_dedup.verify(spark.createDataFrame(checks + [(1, 2, 9, 40, b"other")], schema))


def test_rows_of_null_or_equal_ids_and_frequent_texts(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(None, f"x{i} {passage if i % 3 else 'plain'} y{i}") for i in range(30)] + [(7, "often " * 50)] * 40 + [(8, None)] * 40
    got = substring_dedup.cut_repeats(frame(spark, rows)).collect()
    assert sorted(map(tuple, got), key=repr) == brute_cut(rows, 35)


def test_drop_repeats_takes_any_columns(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    columns = ["doc_id", "text", "k1", "spans", "kept", "n_words", "checks", "of_key", "__of", "goes", "edge"]
    docs = spark.createDataFrame([(i, f"t{i} {passage}", *"abcdefghi") for i in (1, 2)] + [(3, "stays  here", *"abcdefghi")], columns)
    got = substring_dedup.drop_repeats(docs)
    assert got.columns == columns
    assert sorted(map(tuple, got.collect())) == [(1, "t1", *"abcdefghi"), (2, "t2", *"abcdefghi"), (3, "stays  here", *"abcdefghi")]
    assert substring_dedup.drop_repeats(docs.select("doc_id", "text")).columns == ["doc_id", "text"]


def test_drop_repeats_leaves_other_rows_as_they_are(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(1, f"one\n\n  {passage}  end"), (2, f"{passage} two"), (3, "keeps\n its  spaces "), (4, None)]
    docs = spark.createDataFrame([(i, t, None if t is None else len(t), "x") for i, t in rows],
                                 "doc_id long, text string, n_chars long, spans string")
    got = substring_dedup.drop_repeats(docs)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect())) == [(1, "one end", 7, "x"), (2, "two", 3, "x"),
                                                (3, "keeps\n its  spaces ", 19, "x"), (4, None, None, "x")]
    assert substring_dedup.substring_report(docs.limit(0)).count() == 0
