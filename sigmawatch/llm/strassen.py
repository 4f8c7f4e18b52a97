"""Hard-negative mining on exact integer scores.

Scores of a tile of anchors against a tile of candidates are one matrix product by Strassen's
recursion: each operand is padded with zeros and cut in quarters, seven half-size products replace
eight, down to a leaf size. It adds, subtracts and multiplies only, so on int64 it is exact whenever
the scores themselves fit (intermediate sums may wrap around modulo 2**64 without harm); components
too large for that (:func:`narrow`) go through the same recursion as Python integers.

Anchors stream past each group of rows twice. The first pass keeps a heap of each anchor's best rows
of its own label; the heaps of all groups are merged into its positives. The second pass keeps, for
each anchor and positive, a heap of the best rows of another label whose score lies in the window
that the positive's score sets; these heaps are merged likewise.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, slices
from .exact_vectors import (
    as_long, from_key, group_count, is_wide, matrix, order_key, streamed_past, usable, whole,
)

FACTOR = 256
ANCHOR_STEP = 100
RELABEL_STEP = 7
LABELS = 10
POSITIVES = 5
NEGATIVES = 10
#: A negative's score lies between these hundredths of the positive's.
LOWEST, HIGHEST = 30, 90
ANCHOR_TILE = 256
CANDIDATE_TILE = 4_096
#: Operands with a side of at most this are multiplied directly.
LEAF = 32


def _padded(m: np.ndarray, rows: int, cols: int) -> np.ndarray:
    out = np.zeros((rows, cols), m.dtype)
    out[:m.shape[0], :m.shape[1]] = m
    return out


def _levels(sides: tuple[int, ...], leaf: int) -> int:
    """How often the sides can be halved before the shortest is a leaf."""
    side, levels = min(sides), 0
    while side > leaf:
        side, levels = -(-side // 2), levels + 1
    return levels


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` of integers (int64, or Python integers in arrays of dtype object)."""
    sides = (*a.shape, b.shape[1])
    if 0 in sides:
        return np.zeros((a.shape[0], b.shape[1]), a.dtype)
    levels = _levels(sides, leaf)
    step = 1 << levels
    m, k, n = (-(-s // step) * step for s in sides)
    return _halved(_padded(a, m, k), _padded(b, k, n), levels)[:sides[0], :sides[2]]


def _halved(a: np.ndarray, b: np.ndarray, levels: int) -> np.ndarray:
    if not levels:
        return a @ b
    (m, k), n = a.shape, b.shape[1]
    m2, k2, n2 = m // 2, k // 2, n // 2
    a11, a12, a21, a22 = a[:m2, :k2], a[:m2, k2:], a[m2:, :k2], a[m2:, k2:]
    b11, b12, b21, b22 = b[:k2, :n2], b[:k2, n2:], b[k2:, :n2], b[k2:, n2:]
    p1 = _halved(a11 + a22, b11 + b22, levels - 1)
    p2 = _halved(a21 + a22, b11, levels - 1)
    p3 = _halved(a11, b12 - b22, levels - 1)
    p4 = _halved(a22, b21 - b11, levels - 1)
    p5 = _halved(a11 + a12, b22, levels - 1)
    p6 = _halved(a21 - a11, b11 + b12, levels - 1)
    p7 = _halved(a12 - a22, b21 + b22, levels - 1)
    out = np.empty((m, n), p1.dtype)
    out[:m2, :n2] = p1 + p4 - p5 + p7
    out[:m2, n2:] = p3 + p5
    out[m2:, :n2] = p2 + p4
    out[m2:, n2:] = p1 - p2 + p3 + p6
    return out


class Best:
    """A heap of the ``size`` best ``(score, id)``: higher scores, then smaller ids. Heaps of parts
    of the rows merge into that of all of them by :meth:`add`."""

    def __init__(self, size: int) -> None:
        self.size, self.heap = size, []

    def add(self, scores: list[int], ids: list[int]) -> None:
        for pair in zip(scores, (-i for i in ids), strict=True):
            if len(self.heap) < self.size:
                heapq.heappush(self.heap, pair)
            elif pair > self.heap[0]:
                heapq.heapreplace(self.heap, pair)

    def floor(self) -> int | None:
        """The score below which nothing can enter any more."""
        return self.heap[0][0] if len(self.heap) == self.size else None

    def sorted(self) -> list[tuple[int, int]]:
        return [(s, -i) for s, i in sorted(self.heap, reverse=True)]


def offer(best: Best, scores: np.ndarray, ids: np.ndarray, open_: np.ndarray) -> None:
    """Add the best of the rows marked ``open_`` to a heap."""
    least = best.floor()
    if least is not None:
        open_ = open_ & (scores >= least)
    at = np.flatnonzero(open_)
    if len(at) > best.size and scores.dtype != object:
        # Only those from the size-th largest score up, ties included.
        own = scores[at]
        at = at[own >= np.partition(own, len(own) - best.size)[len(own) - best.size]]
    if len(at):
        best.add(scores[at].tolist(), ids[at].tolist())


class Group:
    """The rows of one group, small and large components apart, cut in tiles."""

    def __init__(self, rows: pa.Table, factor: int) -> None:
        x, ids = matrix(rows.column("vec")), rows.column("vec_id").to_numpy()
        labels = rows.column("label").to_numpy()
        self.factor, self.tiles = factor, []
        wide = is_wide(x, factor)
        for pick in (np.flatnonzero(~wide), np.flatnonzero(wide)):
            for at in range(0, len(pick), CANDIDATE_TILE):
                some = pick[at:at + CANDIDATE_TILE]
                self.tiles.append((whole(x[some], factor).T.copy(), ids[some], labels[some]))

    def scores(self, vec: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """``(anchor numbers, scores, ids, labels)`` of every pair of tiles."""
        anchors = matrix(vec)
        wide = is_wide(anchors, self.factor)
        for pick in (np.flatnonzero(~wide), np.flatnonzero(wide)):
            if not len(pick):
                continue
            a = whole(anchors[pick], self.factor)
            for tile, ids, labels in self.tiles:
                exact = object in (a.dtype, tile.dtype)
                product = strassen(a.astype(object), tile.astype(object)) if exact else strassen(a, tile)
                yield pick, product, ids, labels


def _batch(rows: list[tuple], names: tuple[str, ...], kinds: tuple) -> Iterator[pa.RecordBatch]:
    if rows:
        cols = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], list(names))


_LONG, _INT, _KEY = pa.int64(), pa.int32(), pa.binary()
ANCHOR = ("vec_id", "label", "print")


def _positives(group: Group, count: int):
    def run(asked: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for batch in slices([asked], ANCHOR_TILE):
            own = [batch.column(n).to_pylist() for n in ANCHOR]
            heaps = [Best(count) for _ in range(batch.num_rows)]
            for pick, scores, ids, labels in group.scores(batch.column("vec")):
                for row, i in zip(scores, pick.tolist(), strict=True):
                    offer(heaps[i], row, ids, (labels == own[1][i]) & (ids != own[0][i]))
            found = [(*anchor, i, order_key(s), as_long(s))
                     for *anchor, heap in zip(*own, heaps, strict=True) for s, i in heap.sorted()]
            yield from _batch(found, (*ANCHOR, "positive_id", "key", "score"),
                              (_LONG, _INT, _LONG, _LONG, _KEY, _LONG))
    return run


def _negatives(group: Group, count: int, lowest: int, highest: int):
    def run(asked: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for batch in slices([asked], ANCHOR_TILE):
            own = [batch.column(n).to_pylist() for n in ANCHOR]
            # ceil and floor of the window's ends, as integers.
            windows = []
            for positives in batch.column("positives").to_pylist():
                known = [from_key(p["key"]) for p in positives]
                windows.append([(-(-lowest * s // 100), highest * s // 100, Best(count)) for s in known])
            for pick, scores, ids, labels in group.scores(batch.column("vec")):
                for row, i in zip(scores, pick.tolist(), strict=True):
                    other = (labels != own[1][i]) & (ids != own[0][i])
                    for low, high, heap in windows[i]:
                        if low <= high:
                            offer(heap, row, ids, other & (row >= low) & (row <= high))
            found = [(*anchor, p, n, order_key(s), as_long(s))
                     for *anchor, listed in zip(*own, windows, strict=True)
                     for p, (_, _, heap) in enumerate(listed) for s, n in heap.sorted()]
            yield from _batch(found, (*ANCHOR, "place", "negative_id", "key", "score"),
                              (_LONG, _INT, _LONG, _INT, _LONG, _KEY, _LONG))
    return run


def hard_negatives(vectors: DataFrame, vector: str = "embedding", factor: int = FACTOR,
                   anchor_step: int = ANCHOR_STEP, relabel_step: int = RELABEL_STEP,
                   labels: int = LABELS, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   lowest: int = LOWEST, highest: int = HIGHEST) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    A label becomes ``(label + 1) % labels`` where the id is divisible by ``relabel_step``. Scores are
    exact inner products of ``floor(factor * x)``; higher come first, ties by the smaller id. Each row
    whose id is divisible by ``anchor_step`` is an anchor; its positives are its first ``positives``
    other rows of the same label, and for each of them the first ``negatives`` rows of another label
    with ``lowest * positive <= 100 * negative <= highest * positive`` are returned (all, if fewer).

    Rows with a null id, label or vector, or a null or non-finite component, take no part; vectors
    meet those of their own length only. Equal rows count once. "Other" rows have another id; rows
    that share an id but not label or vector are each a candidate and each an anchor of its own. A
    score that does not fit a long is null. Other columns are left out; an empty table gives no rows.
    """
    rows = usable(vectors, vector, "vec_id", "label").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"), "vec")
    moved = F.when(F.col("vec_id") % relabel_step == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    rows = rows.filter("vec_id IS NOT NULL AND label IS NOT NULL").withColumn("label", moved).distinct()
    rows = materialise(rows, "strassen-rows")
    groups = group_count(rows)
    anchors = rows.filter(F.col("vec_id") % anchor_step == 0).withColumn("print", F.xxhash64("vec"))

    near = streamed_past(rows, anchors, groups, lambda held: _positives(Group(held, factor), positives),
                         "vec_id long, label int, print long, positive_id long, key binary, score long")
    first = Window.partitionBy(*ANCHOR).orderBy(F.col("key").desc(), "positive_id")
    near = near.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= positives)
    # At most `positives` of them stand in an anchor's list, best first.
    listed = near.groupBy(*ANCHOR).agg(
        F.array_sort(F.collect_list(F.struct("place", "positive_id", "key", "score"))).alias("positives"))
    asked = materialise(anchors.join(listed, list(ANCHOR)), "strassen-positives")

    far = streamed_past(rows, asked, groups,
                        lambda held: _negatives(Group(held, factor), negatives, lowest, highest),
                        "vec_id long, label int, print long, place int, negative_id long, key binary, score long")
    order = Window.partitionBy(*ANCHOR, "place").orderBy(F.col("key").desc(), "negative_id")
    best = far.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    known = asked.select(*ANCHOR, F.posexplode("positives").alias("place", "p"))
    return (best.join(known, [*ANCHOR, "place"])
            .select(F.col("vec_id").alias("anchor_id"), F.col("p.positive_id").alias("positive_id"), "rank",
                    "negative_id", F.col("p.score").alias("positive_score"), F.col("score").alias("negative_score")))
