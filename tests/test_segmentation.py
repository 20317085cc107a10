import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from basketlens.operators import kmeans, segmentation as seg, silhouette as sil
from basketlens.operators.silhouette import cells, exact_silhouettes, silhouette, silhouettes

SCHEMA = "customer_id bigint, z_recency double, z_frequency double, z_monetary double, segment int"


def points(spark, x, labels):
    rows = [(i, *map(float, p), int(c)) for i, (p, c) in enumerate(zip(x, labels))]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def brute_force(x, labels, squared=False):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    d = d ** 2 if squared else d
    scores = []
    for i, c in enumerate(labels):
        own = labels == c
        if own.sum() == 1:
            scores.append(0.0)
            continue
        a = d[i][own].sum() / (own.sum() - 1)
        b = min(d[i][labels == o].mean() for o in set(labels) if o != c)
        scores.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return np.mean(scores)


def clouds(n, seed=0):
    rng = np.random.default_rng(seed)
    labels = rng.integers(0, 3, n)
    return rng.normal(size=(n, 3)) + labels[:, None] * 1.5, labels


@pytest.mark.parametrize("n, boxes, width", [(40, 16, 0.3), (300, 4, 0.7), (3000, 8, 0.4), (3000, 16, 0.2), (3000, 40, 0.1)])
def test_bounds_hold_the_score_of_all_pairs(spark, n, boxes, width):
    x, labels = clouds(n, n + boxes)
    x[5], labels[7] = x[4], 9      # two identical points, one point alone in its cluster
    df = points(spark, x, labels).cache()
    assert cells(df, seg.SCALED, ["segment"], boxes).groupBy("cluster").count().agg(F.max("count")).first()[0] <= boxes ** 3
    row = silhouette(df, seg.SCALED, "segment", boxes).first()
    truth = brute_force(x, labels)
    assert row.silhouette_low <= truth <= row.silhouette_high
    assert row.silhouette_high - row.silhouette_low < width
    assert abs(row.silhouette - truth) < 0.02 and row.points == n


def test_labellings_scored_together_equal_those_scored_alone(spark):
    x, labels = clouds(600, 6)
    df = points(spark, x, labels).withColumn("half", (F.col("z_recency") > 0).cast("int")).cache()
    both = {r.labelling: r for r in silhouettes(df, seg.SCALED, ["segment", "half"]).collect()}
    for c, truth in (("segment", labels), ("half", (x[:, 0] > 0).astype(int))):
        alone = silhouette(df, seg.SCALED, c).first()
        assert [both[c][f] for f in alone.asDict()] == pytest.approx(list(alone))
        assert both[c].silhouette_low <= brute_force(x, truth) <= both[c].silhouette_high


def test_squared_silhouette_and_single_cluster(spark):
    x, labels = clouds(200, 2)
    df = points(spark, x, labels)
    assert seg.silhouette_squared(df).first()[0] == pytest.approx(brute_force(x, labels, True), abs=1e-9)
    with pytest.raises(ValueError):
        silhouette(points(spark, x, labels * 0), seg.SCALED, "segment")


def test_scaling_uses_population_deviation_and_survives_constants(spark):
    rfm = spark.createDataFrame([(1, 1, 2, 5.0), (2, 2, 2, -5.0), (3, 4, 2, 0.0)],
                                "customer_id bigint, recency_days int, frequency bigint, monetary double")
    rows = seg.scaled_features(rfm).orderBy("customer_id").collect()
    values = np.array([1, 2, 4.0])
    assert [r.z_recency for r in rows] == pytest.approx((values - values.mean()) / values.std())
    assert [r.z_frequency for r in rows] == [0, 0, 0]
    assert rows[0].z_monetary == pytest.approx(-rows[1].z_monetary)


def test_kmeans_finds_separated_clouds_and_k(spark):
    rng = np.random.default_rng(5)
    truth = np.repeat([0, 1, 2], 60)
    x = rng.normal(scale=0.2, size=(180, 3)) + np.array([[-3, 0, 0], [0, 3, 0], [3, 0, 3]])[truth]
    df = points(spark, x, truth).drop("segment").cache()
    rows = seg.choose_k(df, range(2, 5), restarts=2).collect()
    assert [r.k for r in rows if r.chosen] == [3]
    centroids, cost = seg.fit_kmeans(seg.training_points(df), 3, restarts=2)
    assert centroids == sorted(centroids)
    found = {r.customer_id: r.segment for r in seg.kmeans_assign(df, centroids).collect()}
    assert [found[i] for i in range(180)] == list(truth)
    inertia = sum(((x[truth == c] - x[truth == c].mean(0)) ** 2).sum() for c in range(3))
    assert cost == pytest.approx(inertia)


def test_kmeans_gives_the_same_digits_on_any_layout(spark):
    x, labels = clouds(900, 11)
    found = [seg.fit_all(seg.training_points(points(spark, x, labels).repartition(n)), [2, 4], restarts=3) for n in (1, 8, 200)]
    assert found[0] == found[1] == found[2]
    fit = found[0][4]
    assert fit[1] == pytest.approx(seg.kmeans_cost(points(spark, x, labels), fit[0]), rel=1e-6)
    row = seg.kmeans_invariants(points(spark, x, labels), *fit, rivals=[[0.0, 0, 0], [1, 1, 1], [2, 2, 2], [3, 3, 3]]).first()
    assert tuple(row) == (900, True, True, True)
    poor = seg.kmeans_invariants(points(spark, x, labels), [[0.0, 0, 0], [9, 9, 9]], 1e9, rivals=[[1.0, 1, 1]]).first()
    assert tuple(poor)[2:] == (False, False)


def lloyd(x, centres, steps=300):
    """Plain k-means from given centres."""
    for _ in range(steps):
        label = ((x[:, None] - centres[None]) ** 2).sum(-1).argmin(1)
        moved = np.array([x[label == c].mean(0) if (label == c).any() else centres[c] for c in range(len(centres))])
        if np.abs(moved - centres).max() <= 1e-9:
            break
        centres = moved
    return moved


def test_fits_together_equal_a_plain_fit_of_each_start(spark):
    x, labels = clouds(500, 3)
    whole = seg.training_points(points(spark, x, labels))
    starts = kmeans.seeds(whole, 5, range(42, 45), 3)
    assert all(len(s) == 5 for s in starts.values()) and len({str(s) for s in starts.values()}) == 3
    cheapest = lambda k: min(((x[:, None] - lloyd(x, np.array(s[:k]) / kmeans.UNIT)[None]) ** 2).sum(-1).min(1).sum() for s in starts.values())
    for k, (centroids, cost) in seg.fit_all(whole, [2, 3, 5], restarts=3).items():
        assert cost == pytest.approx(cheapest(k), rel=1e-4) and len(centroids) == k


def test_starts_fall_on_far_points_more_often(spark):
    x = np.concatenate([np.zeros((50, 3)), np.full((1, 3), 40.0)])
    starts = kmeans.seeds(seg.training_points(points(spark, x, np.zeros(51))), 3, range(20), 3)
    assert all(len(s) == 2 and {tuple(c) for c in s} == {(0, 0, 0), (int(40 * kmeans.UNIT),) * 3} for s in starts.values())


def test_few_points_and_wrong_numbers(spark):
    same = seg.training_points(points(spark, np.ones((5, 3)), np.zeros(5)))
    assert seg.fit_kmeans(same, 3, restarts=2) == ([[1.0, 1.0, 1.0]] * 3, 0.0)
    for bad in (np.nan, np.inf, 1e6):
        with pytest.raises(Exception, match="z_recency"):
            seg.training_points(points(spark, np.array([[bad, 0, 0]]), [0]))
    with pytest.raises(ValueError):
        seg.fit_kmeans(seg.training_points(points(spark, np.zeros((0, 3)), [])), 2, restarts=1)


@pytest.mark.parametrize("n, blocks", [(40, 16), (3000, 1), (5000, 16)])
def test_exact_scores_equal_all_pairs(spark, n, blocks):
    x, labels = clouds(n, n)
    x[5], labels[7] = x[4], 9
    df = points(spark, x, labels).withColumn("half", (F.col("z_recency") > 0).cast("int")).cache()
    rows = {r.labelling: r for r in exact_silhouettes(df, seg.SCALED, ["segment", "half"], blocks).collect()}
    for c, truth in (("segment", labels), ("half", (x[:, 0] > 0).astype(int))):
        r = rows[c]
        assert r.silhouette == pytest.approx(brute_force(x, truth), abs=1e-10) and r.points == n
        assert r.silhouette_low == r.silhouette == r.silhouette_high
    with pytest.raises(ValueError):
        exact_silhouettes(df.withColumn("one", F.lit(1)), seg.SCALED, ["one"])


def test_the_exact_score_computes_each_distance_once(monkeypatch):
    """The time of the exact score is that of its distances: one for two points, also across the groups of a tile."""
    x, labels = clouds(90, 1)
    block = lambda b: {"block": b, "x": x[30 * b:30 * b + 30].tobytes(), "labels": labels[30 * b:30 * b + 30].astype(np.int32).tobytes()}
    met, strips = [], sil._strips
    monkeypatch.setattr(sil, "_strips", lambda a, b: met.append(len(a) * len(b)) or strips(a, b))
    tile = sil._tile([3], 3)
    parts = [tile((0, 0), pd.DataFrame([block(0) | {"row": True}, block(1) | {"row": True}])),
             tile((0, 1), pd.DataFrame([block(0) | {"row": True}, block(1) | {"row": True}, block(2) | {"row": False}])),
             tile((1, 1), pd.DataFrame([block(2) | {"row": True}])),
             tile((1, 2), pd.DataFrame([block(2) | {"row": True}]))]  # a group without blocks
    assert sum(met) == (90 * 90 + 3 * 30 * 30) / 2
    sums = np.zeros((3, 30, 3))
    for part in parts:
        for b, found in part.itertuples(index=False):
            sums[b] += np.frombuffer(found).reshape(30, 3)
    truth = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)) @ np.eye(3)[labels]
    assert sums.reshape(90, 3) == pytest.approx(truth, rel=1e-12)


@pytest.mark.parametrize("scale, shift", [(1, 0), (1, 1e5), (1e-3, 1), (1e4, 0)])
def test_distances_of_near_and_shifted_points_are_those_of_their_differences(scale, shift):
    rng = np.random.default_rng(4)
    y = rng.normal(size=(150, 3)) * scale + shift
    x = np.concatenate([y[:40], y[:40] + rng.normal(size=(40, 3)) * scale * 1e-5, rng.normal(size=(33, 3)) * scale + shift])
    found = np.concatenate([d.copy() for _, d in sil._strips(x, y)])
    truth = np.sqrt(((x[:, None] - y[None]) ** 2).sum(-1))
    assert np.abs(found - truth).max() < 1e-11 * scale and (found[range(40), range(40)] == 0).all()


def test_distances_of_copies_and_of_numbers_that_are_not_finite():
    rng = np.random.default_rng(5)
    x = np.concatenate([np.tile(rng.normal(size=3), (70, 1)), rng.normal(size=(10, 3))])
    for odd in (0.0, np.nan, np.inf, 1e200):
        x[75, 1] = odd
        with np.errstate(all="ignore"):
            truth = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
            found = np.concatenate([d.copy() for _, d in sil._strips(x, x)])
        assert np.allclose(found, truth, rtol=0, atol=1e-11, equal_nan=True)


def test_exact_scores_of_many_tiles_copies_and_labels(spark):
    x, labels = clouds(9000, 12)
    x[:300], x[300:400] = x[0], x[400:500]
    df = points(spark, x + 1e3, labels).withColumn("parts", F.hash("customer_id") % 7).cache()
    parts = np.array([r.parts for r in df.orderBy("customer_id").select("parts").collect()])
    rows = {r.labelling: r for r in exact_silhouettes(df, seg.SCALED, ["segment", "parts"], 1).collect()}
    y = x + 1e3
    for c, of in (("segment", labels), ("parts", parts)):
        names, own = np.unique(of, return_inverse=True)
        sums = np.concatenate([np.sqrt(((y[a:a + 500, None] - y[None]) ** 2).sum(-1)) @ np.eye(len(names))[own]
                               for a in range(0, len(y), 500)])
        sizes, at = np.bincount(own), np.arange(len(y))
        inside, means = sums[at, own] / (sizes[own] - 1), sums / sizes
        means[at, own] = np.inf
        outside = means.min(axis=1)
        assert rows[c].silhouette == pytest.approx(((outside - inside) / np.maximum(inside, outside)).mean(), abs=1e-10)
        assert rows[c].points == 9000


def test_tiles_of_the_exact_score_are_even_and_one_to_a_task(spark, monkeypatch, tmp_path):
    """A task with several tiles, or a tile of many blocks, would be waited for."""
    x, labels = clouds(13000, 3)
    df = points(spark, x, labels).cache()
    whole, folder = sil._tile, str(tmp_path)

    def noted(*given):
        run = whole(*given)

        def noting(key, frame):
            from pyspark import TaskContext
            sides = sorted([int(frame["row"].sum()), int((~frame["row"]).sum())])
            open(f"{folder}/{key[0]}-{key[1]}-{TaskContext.get().partitionId()}-{sides[0]}-{sides[1]}", "w").close()
            return run(key, frame)
        return noting
    monkeypatch.setattr(sil, "_tile", noted)
    row = exact_silhouettes(df, seg.SCALED, ["segment"], 1).first()
    found = [tuple(map(int, f.name.split("-"))) for f in tmp_path.iterdir()]
    groups = max(j for _, j, *_ in found) + 1
    assert groups >= 7 and len(found) == groups * (groups + 1) // 2
    assert len({task for _, _, task, *_ in found}) == len(found)
    assert all((a, b) == ((0, 1) if i == j else (1, 1)) for i, j, _, a, b in found)
    assert row.points == 13000 and row.silhouette_low == row.silhouette == row.silhouette_high


def test_tiles_of_the_exact_score_widen_with_the_points_up_to_their_memory(spark):
    """A point travels once to each group of blocks, so groups of a fixed size send the square of the points."""
    stored = spark.range(0, 1080, 1, 9).select(F.monotonically_increasing_id().alias("block"), F.lit(b"x").alias("x"),
                                               F.lit(b"l").alias("labels"))
    stored = stored.filter("shiftright(block, 33) <> 4")  # a range of the sort may be empty
    for width, groups in ((14, 32), (70, 60)):  # of 960 blocks 73 on a side are within the memory of a tile, and 14
        tiles = sil._sides(stored, 16, width).groupBy("i", "j", F.spark_partition_id().alias("task")).agg(
            F.sum(F.col("row").cast("int")).alias("here"), F.count("*").alias("both")).toPandas()
        assert len(tiles) == groups * (groups + 1) // 2 == tiles["task"].nunique()
        off = tiles[tiles["i"] < tiles["j"]]
        even = {960 // groups, -(-960 // groups)}
        assert set(off["here"]) | set(off["both"] - off["here"]) == even
        assert off["here"].max() * 2 * sil.BLOCK * 8 * width <= sil.TILE or off["here"].max() == 16


def test_scores_are_refined_until_the_best_is_certain(spark):
    x, labels = clouds(400, 8)
    close = labels.copy()
    close[:2] = (close[:2] + 1) % 3  # almost the same labelling: no coarse grid tells them apart
    rows = [(i, *map(float, p), int(a), int(b), int(i % 2)) for i, (p, a, b) in enumerate(zip(x, labels, close))]
    df = spark.createDataFrame(rows, SCHEMA + ", close int, odd int").cache()
    coarse = seg._scores(silhouettes(df, seg.SCALED, ["segment", "close", "odd"], 4))
    assert sorted(seg.contenders(coarse)) == ["close", "segment"]
    for finest in (4, 64):
        scores = seg.settled(df, ["segment", "close", "odd"], 4, finest)
        assert len(seg.contenders(scores)) == 1
        truth = {"segment": brute_force(x, labels), "close": brute_force(x, close)}
        for c, score in truth.items():
            assert scores[c]["silhouette_low"] - 1e-12 <= score <= scores[c]["silhouette_high"] + 1e-12
        assert seg.contenders(scores) == [max(truth, key=truth.get)]
        assert scores["odd"] == coarse["odd"]  # never in question, never refined
    open_ = seg.settled(df, ["segment", "close", "odd"], 4, 4, all_pairs=399)
    assert len(seg.contenders(open_)) == 2 and open_["segment"] == coarse["segment"]


def test_ties_take_the_first_centroid_and_the_smallest_k(spark):
    df = points(spark, np.zeros((1, 3)), [5])
    assert seg.kmeans_assign(df, [[1.0, 0, 0], [-1.0, 0, 0]]).first().segment == 0
    score = lambda k, low, s, high: {"k": k, "silhouette": s, "silhouette_low": low, "silhouette_high": high}
    tied = seg.best_of([score(2, 0.3, 0.4, 0.5), score(3, 0.3, 0.4, 0.5)])
    assert tied["k"] == 2 and not tied["decided"]
    assert seg.best_of([score(2, 0.1, 0.2, 0.3), score(3, 0.4, 0.45, 0.5)])["decided"]


def test_every_label_rule(spark):
    medians = {"recency_days": 100.0, "frequency": 5.0, "monetary": 50.0}
    cases = {
        seg.NET_NEGATIVE: (10, 9, -1.0),
        seg.CHAMPIONS: (100, 5, 50.0),
        seg.AT_RISK: (101, 4, 99.0),
        seg.NEW: (100, 4, 99.0),
        seg.LOYAL_HIGH: (101, 5, 50.0),
        seg.LOYAL_LOW: (100, 5, 49.0),
    }
    rows = [(i, r, f, float(m), i) for i, (r, f, m) in enumerate(cases.values())]
    df = spark.createDataFrame(rows, "customer_id bigint, recency_days int, frequency bigint, monetary double, segment int")
    got = seg.segment_labels(df, medians).orderBy("customer_id").collect()
    assert [r.segment_label for r in got] == list(cases)


def test_clusters_with_one_label_are_merged_in_the_summary_only(spark):
    rows = [(1, 10, 1, 1.25, 0, "A"), (2, 20, 1, 1.25, 1, "A"), (3, 30, 2, 9.0, 2, "B")]
    df = spark.createDataFrame(rows, "customer_id bigint, recency_days int, frequency bigint, monetary double, "
                                     "segment int, segment_label string")
    assert seg.segment_profile(df).count() == 3
    summary = seg.segment_summary(df).collect()
    assert [(r.segment_label, r.customers, r.avg_monetary) for r in summary] == [("B", 1, 9.0), ("A", 2, 1.2)]
    assert {r.segment_label: r.share for r in seg.segment_share(df).collect()} == pytest.approx({"A": 2 / 3, "B": 1 / 3})
    assert df.select(F.sum("customer_id")).first()[0] == 6
