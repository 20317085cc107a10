"""K-means for many starts and cluster counts at once, with the same answer on any layout of the rows.

Every step is one pass over the points that carries all fits that still move: a task sums counts and coordinates per
fit and cluster, Spark adds the sums, and the next centroids are their quotients. Coordinates are whole multiples of
2**-32, so sums are exact in any order and neither partitions nor a lost task change a digit.

Starts are chosen as k-means++ does, each centre with a probability in proportion to the squared distance from those
before it, one pass for each place. The draw of a point is a hash of its id, the start and the place, turned into the
waiting time of a race; the winner is a minimum, so again no layout matters. A start for k clusters is the first k
places of one sequence, so all cluster counts share the passes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.storagelevel import StorageLevel

from basketlens.session import materialize, ship_package

UNIT = 2.0 ** 32
REACH = 2.0 ** 14  # of a coordinate: beyond it exact sums would need more than 64 bits
STEPS, TOLERANCE = 300, 1e-4
CHUNK = 4096  # points in one distance matrix
_HALF = 23  # bits of the lower half of a coordinate; sums of halves are exact in doubles


def whole_points(points: DataFrame, features: Sequence[str], id_col: str) -> DataFrame:
    """(x0, x1, .., draw): coordinates as whole numbers of 2**-32, and a hash of the id. Stored, as every step reads it."""
    coordinate = lambda c: F.when(F.abs(F.col(c)) < REACH, F.round(F.col(c) * UNIT).cast("bigint")).otherwise(
        F.raise_error(F.concat(F.lit(f"{c} is not a number below {REACH:g} in size: "), F.coalesce(F.col(c).cast("string"), F.lit("null")))))
    whole = points.select(*[coordinate(c).alias(f"x{i}") for i, c in enumerate(features)], F.xxhash64(id_col).alias("draw"))
    return materialize(whole, "whole-points")


def _columns(batch: pa.RecordBatch, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Whole coordinates (dims, rows), and the same as numbers."""
    whole = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(dims)])
    return whole, whole / UNIT


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances (rows, centres), added axis by axis, so that each depends on its own row and centre only."""
    out = np.zeros((x.shape[1], len(centres)))
    for axis, values in enumerate(x):
        out += (values[:, None] - centres[None, :, axis]) ** 2
    return out


def _uniform(draw: np.ndarray, start: int, place: int) -> np.ndarray:
    """Numbers in (0, 1) that depend on the id, the start and the place."""
    z = draw.view(np.uint64) + np.uint64((start * 0x9E3779B97F4A7C15 + (place + 1) * 0xD1342543DE82EF95) % 2 ** 64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(12)).astype(np.float64) / 2.0 ** 52 + 2.0 ** -54


def _race(starts: list[int], chosen: list[list], place: int, dims: int):
    """Per start the point of a batch that comes first: (start, time, x0, x1, ..)."""
    names = ["start", "time", *(f"x{i}" for i in range(dims))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, x = _columns(batch, dims)
            draw = batch.column(dims).to_numpy(zero_copy_only=False)
            rows = []
            for start, centres in zip(starts, chosen):
                weight = _squares(x, np.array(centres) / UNIT).min(axis=1) if centres else np.ones(len(draw))
                with np.errstate(divide="ignore"):
                    time = -np.log(_uniform(draw, start, place)) / weight
                if len(time) and np.isfinite(least := time.min()):
                    first = min(tuple(whole[:, i].tolist()) for i in np.flatnonzero(time == least))
                    rows.append((start, float(least), *first))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(
                [pa.int64(), pa.float64(), *[pa.int64()] * dims])], names)
    return run


def seeds(points: DataFrame, most: int, starts: Sequence[int], dims: int) -> dict[int, list[list[int]]]:
    """For each start up to ``most`` centres in whole coordinates; fewer if there are fewer different points."""
    chosen: dict[int, list[list[int]]] = {s: [] for s in starts}
    for place in range(most):
        race = points.mapInArrow(_race(list(starts), [chosen[s] for s in starts], place, dims),
                                 ", ".join(["start bigint", "time double", *(f"x{i} bigint" for i in range(dims))]))
        winner = F.min(F.struct("time", *(f"x{i}" for i in range(dims)))).alias("winner")
        for row in race.groupBy("start").agg(winner).collect():  # one row for each start
            chosen[row["start"]].append(list(row["winner"])[1:])
    return chosen


def _sums(fits: dict[int, np.ndarray], dims: int):
    """(fit, cluster, n, x0, x1, .., cost): exact sums over the points of a partition; cost in millionths."""
    numbers, centres = list(fits), np.concatenate(list(fits.values()))
    first = np.cumsum([0, *(len(c) for c in fits.values())])
    names = ["fit", "cluster", "n", *(f"x{i}" for i in range(dims)), "cost"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = len(centres)
        counts, sums, cost = np.zeros(total, np.int64), np.zeros((dims, total), object), np.zeros(len(numbers), object)
        for batch in batches:
            for begin in range(0, batch.num_rows, CHUNK):
                whole, x = _columns(batch.slice(begin, CHUNK), dims)
                squares = _squares(x, centres)
                label = np.empty((len(numbers), x.shape[1]), np.int64)
                for i, (a, b) in enumerate(zip(first, first[1:])):
                    nearest = squares[:, a:b].argmin(axis=1)
                    label[i] = a + nearest
                    cost[i] += int(np.rint(squares[np.arange(len(nearest)), a + nearest] * 1e6).astype(np.int64).sum())
                label = label.ravel()
                counts += np.bincount(label, minlength=total)
                for axis in range(dims):
                    for half, unit in ((whole[axis] >> _HALF, 1 << _HALF), (whole[axis] & ((1 << _HALF) - 1), 1)):
                        got = np.bincount(label, np.tile(half.astype(np.float64), len(numbers)), total)
                        sums[axis] += got.astype(np.int64).astype(object) * unit
        rows = [(numbers[i], c, int(counts[a + c]), *(str(sums[axis, a + c]) for axis in range(dims)), str(cost[i]) if not c else "0")
                for i, (a, b) in enumerate(zip(first, first[1:])) for c in range(b - a)]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(
            [pa.int32(), pa.int32(), pa.int64(), *[pa.string()] * (dims + 1)])], names)
    return run


def step(points: DataFrame, fits: dict[int, np.ndarray], dims: int) -> dict[int, tuple[np.ndarray, int]]:
    """One pass: per fit the means of its clusters (an empty one keeps its centre), and the cost of the given centres."""
    schema = ", ".join(["fit int, cluster int, n bigint", *(f"x{i} string" for i in range(dims)), "cost string"])
    added = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    sums = points.mapInArrow(_sums(fits, dims), schema).groupBy("fit", "cluster").agg(
        F.sum("n").alias("n"), *[added(f"x{i}") for i in range(dims)], added("cost"))
    out = {i: (centres.copy(), [0]) for i, centres in fits.items()}
    for row in sums.collect():  # one row for each cluster of each fit
        centres, cost = out[row["fit"]]
        cost[0] += int(row["cost"])
        if row["n"]:
            centres[row["cluster"]] = [int(row[f"x{i}"]) / row["n"] / UNIT for i in range(dims)]
    return {i: (centres, cost[0]) for i, (centres, cost) in out.items()}


def fit_all(points: DataFrame, ks: Sequence[int], starts: Sequence[int], dims: int = 3, steps: int = STEPS,
            tolerance: float = TOLERANCE) -> dict[int, tuple[list[list[float]], float]]:
    """For each k the centroids, in ascending order, and the cost of the cheapest of all starts.

    ``points`` as ``whole_points`` stores them. A fit rests when no centroid moves by more than ``tolerance``. Where
    there are fewer different points than k, some clusters stay empty. Of equal costs the first start counts.
    """
    ship_package(points.sparkSession)
    points = points.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        found = seeds(points, max(ks), starts, dims)
        if not all(found.values()):
            raise ValueError("k-means needs points")
        tasks = [(k, s) for k in ks for s in starts]
        fits = {i: np.array([found[s][min(j, len(found[s]) - 1)] for j in range(k)]) / UNIT for i, (k, s) in enumerate(tasks)}
        moving = dict(fits)
        for _ in range(steps):
            moved = step(points, moving, dims)
            for i, (centres, _) in moved.items():
                if np.sqrt(((centres - fits[i]) ** 2).sum(axis=1)).max() <= tolerance:
                    del moving[i]
                else:
                    moving[i] = centres
                fits[i] = centres
            if not moving:
                break
        costs = {i: cost for i, (_, cost) in step(points, fits, dims).items()}
    finally:
        points.unpersist()
    best = {k: min((i for i, (of, _) in enumerate(tasks) if of == k), key=lambda i: costs[i]) for k in ks}
    return {k: (sorted([float(v) for v in c] for c in fits[i]), costs[i] / 1e6) for k, i in best.items()}
