"""The registered queries against their SQL, and the pipeline stage by stage against brute force."""

import duckdb
import pytest
from test_dedup_operators import brute_components, brute_cut

import corpus_pipeline
from basketlens.llm import packing, quality, queries
from basketlens.session import materialize

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, con, name):
    df = queries.QUERIES[name](spark, SF)
    result = con.execute(queries.SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    order = [columns.index(c) for c in df.columns]
    assert sorted(map(tuple, df.collect())) == sorted(tuple(row[i] for i in order) for row in result.fetchall())


def test_every_operator_is_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "exact dedup", "n-gram Jaccard join", "substring dedup", "best-fit packing"]


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, SF), "stage")
        assert docs.columns == columns, name
        seen.append({r.doc_id: r for r in docs.collect()})
    good, distinct, apart, cut = seen

    raw = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scores = {r.doc_id: r.predicted for r in quality.quality_report(
        spark.read.parquet(f"{SF}/documents.parquet"), labels).collect()}
    assert set(good) == {i for i, p in scores.items() if p == 1} and all(good[i] == raw[i] for i in good)
    label = {r.doc_id: r.quality for r in labels.collect()}
    clean = [i for i in raw if label.get(i) == 1]
    assert sum(i in good for i in clean) >= 0.97 * len(clean)

    last = {}
    for i, r in good.items():
        key = (r.text or "").encode().lower()
        last[key] = max(last.get(key, i), i)
    assert set(distinct) == set(last.values()) and all(distinct[i] == raw[i] for i in distinct)

    rows = sorted((i, r.text) for i, r in distinct.items())
    assert set(apart) == {i for i, _, c, _ in brute_components(rows, 80, 5) if i == c}

    want = brute_cut(sorted((i, r.text) for i, r in apart.items()), 35)
    assert set(cut) == set(apart)
    for i, _, removed, kept in want:
        assert cut[i].text == (kept if removed else raw[i].text) and cut[i].n_chars == len(cut[i].text)

    rows = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert sorted((r.doc_id, r.piece) for r in rows) == sorted(
        (i, p) for i, r in cut.items() for p in range(max(1, -(-len(r.text.encode().split()) // packing.CAPACITY))))
    for number in {r.bin for r in rows} - {None}:
        held = [r for r in rows if r.bin == number]
        assert sum(r.length for r in held) <= packing.CAPACITY and len({cut[r.doc_id].source for r in held}) == len(held)


def test_pipeline_of_repeated_rows_null_ids_and_one_id_with_two_texts(spark, tmp_path):
    # Without labels the first stage keeps all rows.
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(50)) for x in "abcd")
    rows = [(1, a)] * 3 + [(1, a.upper()), (2, b), (2, c), (3, c), (3, c + " end")] + [(None, d)] * 2 + [(None, a), (None, "")]
    rows = [(i, t, "en", f"s{k}", len(t)) for k, (i, t) in enumerate(rows)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, str(tmp_path)), "stage")
    got = sorted(((r.doc_id, r.text.lower()) for r in docs.collect()), key=repr)
    assert [(i, t.removesuffix(" end")) for i, t in got] == sorted([(1, a), (2, b), (3, c), (None, d), (None, "")], key=repr)
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(((r.doc_id, r.length) for r in packed), key=repr) == sorted(
        ((i, len(t.split())) for i, t in got), key=repr)
