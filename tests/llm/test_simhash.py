"""Fingerprints and their components against brute force."""

import random

import numpy as np
import pytest
import xxhash

from basketlens.llm import simhash


def brute_fingerprint(text, width=3):
    words = (text or "").encode().translate(simhash._LOWER).split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def brute(rows, threshold=2):
    prints = [brute_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= threshold:
                root[find(i)] = find(j)
    groups = {}
    for i, (k, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(k)
    least = {r: min((k for k in ids if k is not None), default=None) for r, ids in groups.items()}
    return [(k, f"{prints[i]:016x}", least[find(i)]) for i, (k, _) in enumerate(rows)]


def found(spark, rows, **how):
    df = spark.createDataFrame([(*r, "x", 1, 2, 3, 4) for r in rows],
                               "doc_id long, text string, fingerprint string, own int, times int, anchor int, node int")
    return sorted(map(tuple, simhash.near_duplicates(df.repartition(3), **how).collect()), key=repr)


@pytest.mark.parametrize("threshold", [0, 1, 2, 3, 4])
def test_values_within_the_threshold_share_an_anchor(threshold):
    draw, reach = random.Random(threshold), 1 + -(-threshold // 2)
    for _ in range(40):
        a = draw.getrandbits(64)
        b = a
        for bit in draw.sample(range(64), threshold):
            b ^= 1 << bit
        near = [set(simhash.anchors(np.array([x], np.uint64), reach)[0].tolist()) for x in (a, b)]
        assert near[0] & near[1]
        assert all((x ^ a).bit_count() <= reach for x in near[0])
        assert not simhash.syndromes(np.array(list(near[0]), np.uint64)).any()


def test_every_value_has_an_anchor_within_one_bit():
    values = np.random.default_rng(1).integers(0, 2 ** 64, 5000, np.uint64)
    of = simhash.anchors(values, 1)[1]
    assert len(np.unique(of)) == len(np.unique(values))
    assert np.bincount(np.searchsorted(np.sort(values), simhash.anchors(values, 2)[1])).max() <= 33


def test_components_equal_brute_force(spark):
    draw = random.Random(11)
    rows = []
    for _ in range(60):
        base = [draw.choice("abcdefghij") * draw.randint(1, 4) for _ in range(draw.choice([1, 2, 3, 4, 30, 200, 900]))]
        for _ in range(draw.randint(1, 6)):
            words = list(base)
            for _ in range(draw.choice([0, 1, 2])):
                words[draw.randrange(len(words))] = draw.choice(["Zeta", "yota", "É"])
            rows.append((len(rows), draw.choice([" ", " \n", "\t"]).join(words)))
    rows += [(900, None), (901, ""), (902, " \t\n"), (None, "a b"), (None, "a b"), (903, "A b"), (904, "a\x1cb c"), (None, "only null")]
    want = brute(rows)
    assert len({c for _, _, c in want}) < len(rows) - 30
    assert found(spark, rows) == sorted(want, key=repr)


def test_chains_of_fingerprints_and_full_anchors(spark):
    # A ball of values around one anchor, chains of two-bit steps, and far values, as fingerprints.
    draw = random.Random(5)
    values = {0} | {1 << i for i in range(64)} | {1 << i | 1 << j for i in range(64) for j in range(i)}
    at = draw.getrandbits(64) | 1 << 63
    for _ in range(300):
        values.add(at)
        at ^= (1 << draw.randrange(64)) | (1 << draw.randrange(64))
    values |= {draw.getrandbits(64) for _ in range(300)}
    values = np.array(sorted(values), np.uint64)
    links = simhash.spanning(values, 2)
    label = list(range(len(values)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i
    for i, j in links:
        label[max(find(i), find(j))] = min(find(i), find(j))
    want = {}
    for i in range(len(values)):
        want.setdefault(find(i), set()).add(int(values[i].view(np.int64)))
    df = spark.createDataFrame([(int(v.view(np.int64)),) for v in values], "fingerprint long").repartition(5)
    got = {}
    for r in simhash.linked_fingerprints(df).collect():
        got.setdefault(r.root, set()).add(r.node)
    assert sorted(map(sorted, got.values())) == sorted(sorted(g) for g in want.values() if len(g) > 1)
    assert all(root == min(group) for root, group in got.items())


def test_one_text_with_most_rows_and_no_rows(spark):
    rows = [(i, "The same words over and over") for i in range(3000, 0, -1)] + [(0, "other words"), (5000, "third")]
    got = found(spark, rows)
    assert got == sorted(brute(rows[-3:]) + [(i, f"{brute_fingerprint(rows[0][1]):016x}", 1)
                                             for i in range(2, 3001)], key=repr)
    assert found(spark, []) == []


def test_long_texts_are_read_piece_by_piece():
    draw = random.Random(3)
    text = " ".join(draw.choice(["ab", "Cde", "fghij" * 20]) for _ in range(3000)) + " " + "x" * 5000 + "  y"
    for most in (1, 7, 100, 4096, 1 << 20):
        assert simhash.fingerprint(text.encode(), most=most) % 2 ** 64 == brute_fingerprint(text)
    for short in ("", " ", "one", "one two", "one two three"):
        assert simhash.fingerprint(short.encode(), most=1) % 2 ** 64 == brute_fingerprint(short)
    with pytest.raises(ValueError):
        simhash.linked_fingerprints(None, 5)


def test_registered_query_equals_brute_force(spark):
    from basketlens.llm import queries
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert sorted(map(tuple, queries.op11_simhash(spark, folder).collect())) == sorted(brute(rows))
