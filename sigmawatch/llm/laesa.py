"""Centroid clustering (k-means on integers) with a pivot table.

The start centroids serve as fixed pivots: each vector's distances to them are computed once and
written beside it. By the triangle inequality ``|d(x, p) - d(c, p)|`` never exceeds ``d(x, c)``, so
the largest of these differences bounds a centroid's distance from below. Each round visits a
vector's centroids in the order of their bounds and computes exact integer distances only while the
bound does not exceed the best found; the others cannot win.

Every round is one pass over the pivot table. Tasks send partial sums, as 31-bit limbs that add up
exactly in Spark whatever their size; the driver holds the centroids and nothing that grows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, slices
from .exact_vectors import as_long, is_wide, matrix, usable, whole

CLUSTERS = 16
ROUNDS = 3
DIMS = 64
FACTOR = 64
SEED = 1
SLICE_ROWS = 4_096
LIMB = 31
#: Relative slack of the bounds, far above the rounding of a double square root.
SLACK = 1e-12


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of integers (int64, or dtype object)."""
    d = a - b
    return (d * d).sum(-1)


def roots(exact: np.ndarray) -> np.ndarray:
    """Square roots as doubles; infinite beyond a double's range."""
    if exact.dtype != object:
        return np.sqrt(exact.astype(np.float64))
    flat = [float(v) ** 0.5 if v.bit_length() < 1_000 else float("inf") for v in exact.ravel().tolist()]
    return np.array(flat, np.float64).reshape(exact.shape)


def pivot_distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.stack([roots(squared(x, p)) for p in pivots], axis=1)


def assign(x: np.ndarray, far: np.ndarray, centroids: np.ndarray,
           centroid_far: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of each row (ties: smaller number), exact squared distance, and how many
    exact distances it took. ``far``, ``centroid_far``: distances to the pivots."""
    n, k = len(x), len(centroids)
    with np.errstate(invalid="ignore"):
        gaps = np.abs(far[:, None, :] - centroid_far[None, :, :])
        gaps -= SLACK * (far[:, None, :] + centroid_far[None, :, :])
    # Where a distance is beyond a double, no bound is known.
    bound = np.maximum(np.where(np.isfinite(gaps), gaps, 0.0).max(2), 0.0)
    order = np.argsort(bound, axis=1, kind="stable")
    bound = np.take_along_axis(bound, order, 1)
    label = order[:, 0].copy()
    best = squared(x, centroids[label])
    reach = roots(best) * (1 + SLACK)
    spent = n
    for step in range(1, k):
        # Bounds rise from step to step, so a row that stops here has no later candidate.
        alive = np.flatnonzero(bound[:, step] <= reach)
        if not len(alive):
            break
        spent += len(alive)
        at = order[alive, step]
        d = squared(x[alive], centroids[at])
        won = np.asarray((d < best[alive]) | ((d == best[alive]) & (at < label[alive])), bool)
        rows = alive[won]
        best[rows], label[rows] = d[won], at[won]
        reach[rows] = roots(best[rows]) * (1 + SLACK)
    return label, best, spent


def _centroids(rows: list[list[int]]) -> np.ndarray:
    """Centroids as an array: int64 where the sizes allow, else Python integers."""
    out = np.empty((len(rows), len(rows[0])), object)
    out[:] = rows
    small = max(abs(v) for r in rows for v in r) < 1 << 27
    return out.astype(np.int64) if small else out


def limbs(value: int) -> list[int]:
    """``value`` as parts below 2**31 that count ``2**31`` times the one before; the last is signed."""
    out = []
    while not -(1 << LIMB) <= value < 1 << LIMB:
        out.append(value & ((1 << LIMB) - 1))
        value >>= LIMB
    return [*out, value]


def _parts(batch: pa.RecordBatch, factor: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row numbers, integers and pivot distances: rows of small and of large components apart."""
    x, far = matrix(batch.column("vec")), matrix(batch.column("far"))
    wide = is_wide(x, factor)
    for pick in (np.flatnonzero(~wide), np.flatnonzero(wide)):
        if len(pick):
            yield pick, whole(x[pick], factor), far[pick]


def clusters(vectors: DataFrame, vector: str = "embedding", k: int = CLUSTERS, rounds: int = ROUNDS,
             dims: int = DIMS, factor: int = FACTOR, seed: int = SEED) -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)``, one row per vector
    of exactly ``dims`` components, none of them null or non-finite; other rows take no part.

    Components become ``floor(factor * x)``. The centroids start as the ``k`` vectors with the
    smallest SHA-256 of ``"<seed>:<vec_id>"`` (a null id counts as empty text; ties by vector), or
    all vectors if there are fewer. Each round assigns every vector to its nearest centroid (squared
    Euclidean distance, ties to the smaller number) and moves each centroid that has any to the
    exact ``floor(sum / count)`` of its vectors; then vectors are assigned once more.

    Repeated rows count as often as they occur; other columns are left out; an empty table gives no
    rows. All sums are exact whatever the size of the components; a distance or inertia that does
    not fit a long is null, and so is an inertia over such a distance.
    """
    rows = usable(vectors, vector, "vec_id").filter(F.size("vec") == dims)
    rows = rows.withColumn("vec_id", F.col("vec_id").cast("long"))
    ticket = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = rows.select(ticket.alias("ticket"), "vec").orderBy("ticket", "vec").limit(k).collect()
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not first:
        return vectors.sparkSession.createDataFrame([], schema)
    start = whole(np.array([r["vec"] for r in first], np.float64), factor)
    pivots = centers = _centroids(start.tolist())

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, SLICE_ROWS):
            x = matrix(b.column("vec"))
            far = np.empty((len(x), len(pivots)))
            wide = is_wide(x, factor)
            for pick in (np.flatnonzero(~wide), np.flatnonzero(wide)):
                if len(pick):
                    far[pick] = pivot_distances(whole(x[pick], factor), pivots)
            offsets = pa.array(np.arange(0, far.size + 1, len(pivots), dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("vec"), pa.ListArray.from_arrays(offsets, pa.array(far.ravel()))],
                ["vec_id", "vec", "far"])

    kind = rows.schema["vec"].dataType.simpleString()
    table = materialise(rows.mapInArrow(measured, f"vec_id long, vec {kind}, far array<double>"), "laesa-pivots")

    def sums(centers: np.ndarray):
        center_far = pivot_distances(centers, pivots)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, list[int]] = {}
            for b in slices(batches, SLICE_ROWS):
                for _, x, far in _parts(b, factor):
                    label = assign(x, far, centers, center_far)[0]
                    for c in np.unique(label).tolist():
                        own = x[label == c]
                        add = [*own.sum(0).tolist(), len(own)]
                        total[c] = [a + v for a, v in zip(total.get(c, [0] * len(add)), add, strict=True)]
            out = [(c, at, i, part) for c, values in total.items() for at, value in enumerate(values)
                   for i, part in enumerate(limbs(value))]
            if out:
                cols = zip(*out, strict=True)
                kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(cols, kinds, strict=True)],
                                                 ["cluster", "at", "limb", "part"])
        return run

    for _ in range(rounds):
        partial = table.mapInArrow(sums(centers), "cluster int, at int, limb int, part long")
        # At most k * (dims + 1) sums of a few limbs each: a size set by parameters.
        moved: dict[int, list[int]] = {}
        for r in partial.groupBy("cluster", "at", "limb").agg(F.sum("part").alias("part")).collect():
            values = moved.setdefault(r["cluster"], [0] * (dims + 1))
            values[r["at"]] += r["part"] << (LIMB * r["limb"])
        centers = _centroids([[v // moved[c][-1] for v in moved[c][:-1]] if c in moved else old
                              for c, old in enumerate(centers.tolist())])

    center_far = pivot_distances(centers, pivots)

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, SLICE_ROWS):
            label, distance = np.empty(b.num_rows, np.int32), [None] * b.num_rows
            for pick, x, far in _parts(b, factor):
                label[pick], best, _ = assign(x, far, centers, center_far)
                for i, d in zip(pick.tolist(), best.tolist(), strict=True):
                    distance[i] = as_long(d)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), pa.array(label), pa.array(distance, pa.int64())],
                ["vec_id", "cluster", "distance"])

    final = materialise(table.mapInArrow(assigned, "vec_id long, cluster int, distance long"), "laesa-assigned")
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    held = {r["cluster"]: int(r["total"]) if r["known"] == r["n"] else None for r in final.groupBy("cluster").agg(
        exact.alias("total"), F.count("distance").alias("known"), F.count(F.lit(1)).alias("n")).collect()}
    overall = None if None in held.values() else as_long(sum(held.values()))
    listed = [(c, None if t is None else as_long(t), overall,
               hashlib.sha256(",".join(map(str, centers[c].tolist())).encode()).hexdigest()) for c, t in held.items()]
    # One row per cluster, k at most.
    about = vectors.sparkSession.createDataFrame(
        listed, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return final.join(F.broadcast(about), "cluster").select(*[c.split()[0] for c in schema.split(", ")])
