"""Customer segments: scaled features, k-means, choice of k, descriptive labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from basketlens.functions.scalars import signed_log
from basketlens.operators import kmeans
from basketlens.operators.silhouette import BOXES, exact_silhouettes, silhouettes

FEATURES = ["recency_days", "frequency", "monetary"]
SCALED = ["z_recency", "z_frequency", "z_monetary"]
FINEST = 32  # boxes per axis of the finest grid, so at most 32,768 cells for each cluster
ALL_PAIRS = 1_000_000  # points up to which what the finest grid leaves open is scored over all pairs

# Search range, seed and restarts of the segmentation, and the segment names.
K_RANGE = range(2, 9)
SEED = 42
RESTARTS = 10
NET_NEGATIVE = "Net Negative / Returners"
CHAMPIONS = "Champions"
AT_RISK = "At Risk / Churned"
NEW = "New / Occasional"
LOYAL_HIGH = "Loyal High-Value"
LOYAL_LOW = "Loyal Low-Value"


def log_features(rfm: DataFrame) -> DataFrame:
    """Recency as it is, log of frequency, signed log of spend (which may be negative)."""
    return rfm.withColumns({
        "z_recency": F.col("recency_days").cast("double"),
        "z_frequency": F.log1p(F.col("frequency").cast("double")),
        "z_monetary": signed_log(F.col("monetary").cast("double")),
    })


def scaled_features(rfm: DataFrame) -> DataFrame:
    """Add the three features standardised by population deviation; a constant feature becomes 0.

    Reads ``rfm`` once for six numbers: pass a stored frame.
    """
    features = log_features(rfm)
    stats = features.agg(
        *[F.avg(c).alias(f"{c}_mean") for c in SCALED], *[F.stddev_pop(c).alias(f"{c}_sd") for c in SCALED]).first()
    scale = lambda c: (F.col(c) - F.lit(stats[f"{c}_mean"])) / F.lit(stats[f"{c}_sd"] or 1.0)
    return features.withColumns({c: scale(c) for c in SCALED})


def kmeans_assign(scaled: DataFrame, centroids: Sequence[Sequence[float]], segment: str = "segment") -> DataFrame:
    """Nearest of the given centroids, the first one on a tie. Pure column arithmetic, no join."""
    def reach(number: int, centroid: Sequence[float]) -> Column:
        squares = [(F.col(c) - F.lit(float(x))) ** 2 for c, x in zip(SCALED, centroid)]
        return F.struct((squares[0] + squares[1] + squares[2]).alias("distance"), F.lit(number).alias("number"))
    reaches = [reach(i, c) for i, c in enumerate(centroids)]
    return scaled.withColumn(segment, (F.least(*reaches) if len(reaches) > 1 else reaches[0])["number"])


def training_points(scaled: DataFrame) -> DataFrame:
    """The points as k-means reads them, stored."""
    return kmeans.whole_points(scaled, SCALED, "customer_id")


def fit_all(points: DataFrame, ks: Sequence[int], restarts: int = RESTARTS, seed: int = SEED) -> dict[int, tuple[list, float]]:
    """For each k the centroids, in ascending order, and the cost of the cheapest of several starts, all fitted together."""
    return kmeans.fit_all(points, list(ks), range(seed, seed + restarts), len(SCALED))


def fit_kmeans(points: DataFrame, k: int, restarts: int = RESTARTS, seed: int = SEED) -> tuple[list, float]:
    """``fit_all`` for a single k."""
    return fit_all(points, [k], restarts, seed)[k]


def kmeans_cost(scaled: DataFrame, centroids: Sequence[Sequence[float]]) -> float:
    """Sum of squared distances to the nearest centroid."""
    squares = [sum((F.col(c) - F.lit(float(x))) ** 2 for c, x in zip(SCALED, centroid)) for centroid in centroids]
    return scaled.agg(F.sum(F.least(*squares) if len(squares) > 1 else squares[0])).first()[0]


def kmeans_search(scaled: DataFrame, ks: Sequence[int] = K_RANGE, restarts: int = RESTARTS, seed: int = SEED,
                  baseline: str | None = None, given: Mapping[int, Sequence[Sequence[float]]] | None = None,
                  boxes: int = BOXES, settle: bool = True) -> tuple[list[dict], dict | None]:
    """Fit every k, or take the ``given`` centroids by k, then score all of them, and a ``baseline`` label column.

    Returns one dict per k with its centroids, cost, silhouette and its bounds, and the score of the baseline. All are
    scored in one pass; with ``settle``, those that might still be the best are scored again by finer grids, and at
    last over all pairs, until one is the best.
    """
    if given is None:
        fits = fit_all(training_points(scaled), ks, restarts, seed)
    else:
        fits = {k: (centroids, kmeans_cost(scaled, centroids)) for k, centroids in given.items()}
    labelled = scaled
    for k, (centroids, _) in fits.items():
        labelled = kmeans_assign(labelled, centroids, f"segment_{k}")
    columns = [*(f"segment_{k}" for k in fits), *([baseline] if baseline else [])]
    scores = settled(labelled, columns, boxes) if settle else _scores(silhouettes(labelled, SCALED, columns, boxes))
    search = [{"k": k, "centroids": centroids, "cost": cost, **scores[f"segment_{k}"]}
              for k, (centroids, cost) in fits.items()]
    return search, scores.get(baseline)


def _scores(table: DataFrame) -> dict[str, dict]:
    return {row["labelling"]: row.asDict() for row in table.collect()}


def contenders(scores: Mapping[str, Mapping]) -> list[str]:
    """Labellings whose upper bound reaches the lower bound of the best one; that one alone if it is decided."""
    best = max(scores.values(), key=lambda s: s["silhouette_low"])
    return [name for name, s in scores.items() if s["silhouette_high"] >= best["silhouette_low"]]


def settled(labelled: DataFrame, columns: Sequence[str], boxes: int = BOXES, finest: int = FINEST,
            all_pairs: int = ALL_PAIRS) -> dict[str, dict]:
    """Scores by label column, refined until the best one is certain.

    Each round doubles the boxes of the grid for those whose bounds overlap that of the best; beyond ``finest`` boxes
    they are scored over all pairs, after which only labellings of equal scores remain together. That work is the
    square of the rows: with more than ``all_pairs`` points the bounds of the finest grid stand, and say what is open.
    """
    scores = _scores(silhouettes(labelled, SCALED, columns, boxes))
    while len(open_ := contenders(scores)) > 1 and boxes < finest:
        boxes *= 2
        scores |= _scores(silhouettes(labelled, SCALED, open_, boxes))
    if len(open_) > 1 and scores[open_[0]]["points"] <= all_pairs:
        scores |= _scores(exact_silhouettes(labelled, SCALED, open_))
    return scores


def best_of(search: list[dict]) -> dict:
    """Highest silhouette, the smallest k on a tie.

    ``decided`` tells whether its lower bound is above the upper bounds of all others.
    """
    best = max(search, key=lambda fit: (fit["silhouette"], -fit["k"]))
    others = [fit["silhouette_high"] for fit in search if fit["k"] != best["k"]]
    return {**best, "decided": all(best["silhouette_low"] > high for high in others)}


SEARCH = "k int, cost double, silhouette double, silhouette_low double, silhouette_high double, chosen boolean, decided boolean"


def search_rows(search: list[dict]) -> list[tuple]:
    best = best_of(search)
    return [(f["k"], f["cost"], f["silhouette"], f["silhouette_low"], f["silhouette_high"], f["k"] == best["k"],
             best["decided"]) for f in search]


def choose_k(scaled: DataFrame, ks: Sequence[int] = K_RANGE, restarts: int = RESTARTS, seed: int = SEED,
             given: Mapping[int, Sequence[Sequence[float]]] | None = None, settle: bool = True) -> DataFrame:
    """One row per k with cost, silhouette, its bounds, the choice, and whether the bounds decide it."""
    search, _ = kmeans_search(scaled, ks, restarts, seed, given=given, settle=settle)
    return scaled.sparkSession.createDataFrame(search_rows(search), SEARCH)


def kmeans_invariants(scaled: DataFrame, centroids: Sequence[Sequence[float]], cost: float,
                      rivals: Sequence[Sequence[float]], tolerance: float = 1e-3) -> DataFrame:
    """What any good fit has, as one row: all customers labelled, each at its nearest centroid, centroids that a
    further step doesn't move beyond ``tolerance``, a cost not above that of the ``rivals``."""
    labelled = kmeans_assign(scaled, centroids)
    squares = F.array(*[sum((F.col(c) - F.lit(float(x))) ** 2 for c, x in zip(SCALED, centroid)) for centroid in centroids])
    sums = labelled.agg(F.count("segment").alias("labelled"),
                        F.bool_and(F.get(squares, "segment") <= F.array_min(squares)).alias("nearest")).first()
    means = labelled.groupBy("segment").agg(*[F.avg(c).alias(c) for c in SCALED]).collect()
    moved = max(float(np.abs(np.array([r[c] for c in SCALED]) - np.array(centroids[r["segment"]])).max()) for r in means)
    row = (sums["labelled"], sums["nearest"], len(means) == len(centroids) and moved <= tolerance,
           cost <= kmeans_cost(scaled, rivals) * (1 + 1e-9))
    return scaled.sparkSession.createDataFrame([row], "labelled bigint, nearest boolean, settled boolean, cheap boolean")


def silhouette_squared(labelled: DataFrame, segment: str = "segment") -> DataFrame:
    """Mean silhouette over squared distances: linear in the rows, but not the same number or the same best k."""
    vectors = VectorAssembler(inputCols=SCALED, outputCol="features").transform(labelled)
    score = ClusteringEvaluator(predictionCol=segment).evaluate(vectors)
    return labelled.sparkSession.createDataFrame([(score,)], "silhouette_squared double")


def cluster_centroids(labelled: DataFrame) -> DataFrame:
    """Mean of the raw features per cluster."""
    return labelled.groupBy("segment").agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in FEATURES])


def label_rule(medians) -> Column:
    """Ordered rules on a centroid against the customer medians."""
    recent = F.col("recency_days") <= medians["recency_days"]
    frequent = F.col("frequency") >= medians["frequency"]
    valuable = F.col("monetary") >= medians["monetary"]
    return (
        F.when(F.col("monetary") < 0, NET_NEGATIVE)
        .when(recent & frequent & valuable, CHAMPIONS)
        .when(~recent & ~frequent, AT_RISK)
        .when(recent & ~frequent, NEW)
        .when(valuable, LOYAL_HIGH)
        .otherwise(LOYAL_LOW)
    )


def segment_labels(labelled: DataFrame, medians) -> DataFrame:
    """Name the cluster of every customer. ``medians`` is the row of ``rfm_medians``.

    Clusters may share a name, and a name may go unused. The broadcast side has one row per cluster.
    """
    named = cluster_centroids(labelled).select("segment", label_rule(medians).alias("segment_label"))
    return labelled.join(F.broadcast(named), "segment", "left")


def _profile(segments: DataFrame, *keys: str) -> DataFrame:
    mean = lambda c: F.bround(F.avg(F.col(c).cast("double")), 1)
    return segments.groupBy(*keys).agg(
        F.count("customer_id").alias("customers"),
        mean("recency_days").alias("avg_recency_days"),
        mean("frequency").alias("avg_frequency"),
        mean("monetary").alias("avg_monetary"),
    )


def segment_profile(segments: DataFrame) -> DataFrame:
    """Size and mean features per cluster."""
    return _profile(segments, "segment", "segment_label")


def segment_summary(segments: DataFrame) -> DataFrame:
    """Size and mean features per name, best spenders first; clusters with one name are merged."""
    return _profile(segments, "segment_label").orderBy(F.col("avg_monetary").desc(), "segment_label")


def segment_share(segments: DataFrame) -> DataFrame:
    """Customers per name and their share of the base."""
    counts = segments.groupBy("segment_label").agg(F.count("*").alias("customers"))
    every = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)  # one row per name
    return counts.withColumn("share", F.col("customers") / F.sum("customers").over(every))
