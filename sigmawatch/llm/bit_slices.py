"""Exact top-k search by a bit-sliced index.

A block of rows is held as bitmaps: one per attribute (vector component) and bit of its quantised
value, counted from the block's smallest. A query's inner product with all rows of the block is then
added up in bitmaps: each of the query's components is written in signed binary digits, every digit
adds the attribute's slices (or their complement, for a digit of -1) at its weight, and full adders
bring each weight down to one slice. The best rows are read from the most significant slice downward:
rows with a set bit are ahead of those without. Rows that tie at the boundary after the last slice
are taken by id; the scores of the rows taken are computed from the exact integers.

Rows with very large components (:func:`narrow`), which would need hundreds of slices, stand beside
the bitmaps and are scored one by one with Python integers, as are queries that have such components.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, slices
from .exact_vectors import as_long, group_count, is_wide, matrix, order_key, streamed_past, usable, whole

K = 5
QUERY_STEP = 50
FACTOR = 256
BATCH = 256
#: Bitmaps of fewer rows cost more calls than bits.
GROUP_ROWS = 16_384


def signed_digits(value: int) -> list[tuple[int, int]]:
    """``(bit, digit)`` with digits 1 and -1, no two of them on neighbouring bits."""
    out, bit = [], 0
    while value:
        if value & 1:
            digit = 2 - (value & 3)
            out.append((bit, digit))
            value -= digit
        value >>= 1
        bit += 1
    return out


def positions(bitmap: np.ndarray, most: int) -> list[int]:
    """The first ``most`` set bits."""
    out: list[int] = []
    for word in np.flatnonzero(bitmap):
        value = int(bitmap[word])
        while value and len(out) < most:
            low = value & -value
            out.append(64 * int(word) + low.bit_length() - 1)
            value ^= low
        if len(out) >= most:
            break
    return out


class BitSlices:
    """Bitmaps of the int64 rows ``x``, whose order breaks ties."""

    def __init__(self, x: np.ndarray) -> None:
        self.x = x
        n, dims = x.shape
        self.words = -(-n // 64)
        self.valid = self._bitmap(np.ones(n, bool))
        self.low = x.min(0) if n else np.zeros(dims, np.int64)
        shifted = x - self.low
        widths = [int(m).bit_length() for m in shifted.max(0)] if n else [0] * dims
        self.plain = [[self._bitmap(shifted[:, j] >> i & 1) for i in range(w)] for j, w in enumerate(widths)]
        self.inverse = [[~s for s in attribute] for attribute in self.plain]

    def _bitmap(self, flags: np.ndarray) -> np.ndarray:
        packed = np.packbits(flags.astype(np.uint8), bitorder="little")
        return np.pad(packed, (0, 8 * self.words - len(packed))).view("<u8")

    def score_slices(self, query: list[int]) -> list[np.ndarray]:
        """Slices, least significant first, of each row's inner product with ``query`` less a number
        that is the same for all rows (a digit of -1 adds ``~v = 2**width - 1 - v``)."""
        columns: list[list[np.ndarray]] = []
        for j, value in enumerate(query):
            for bit, digit in signed_digits(value):
                attribute = self.plain[j] if digit > 0 else self.inverse[j]
                while len(columns) < bit + len(attribute):
                    columns.append([])
                for i, s in enumerate(attribute):
                    columns[bit + i].append(s)
        at = 0
        while at < len(columns):
            column = columns[at]
            if len(column) > 1 and at + 1 == len(columns):
                columns.append([])
            while len(column) > 2:
                a, b, c = column.pop(), column.pop(), column.pop()
                odd = a ^ b
                columns[at + 1].append(a & b | odd & c)
                column.append(odd ^ c)
            if len(column) == 2:
                a, b = column
                columns[at + 1].append(a & b)
                columns[at] = [a ^ b]
            at += 1
        return [c[0] if c else np.zeros(self.words, np.uint64) for c in columns]

    def top(self, query: list[int], k: int, barred: slice = slice(0, 0)) -> list[int]:
        """Rows of the ``k`` largest inner products with ``query``, ties to earlier rows; rows of
        ``barred`` take no part."""
        maybe = self.valid.copy()
        for row in range(barred.start, barred.stop):
            maybe[row >> 6] &= ~np.uint64(1 << (row & 63))
        sure, n_sure = np.zeros(self.words, np.uint64), 0
        for s in reversed(self.score_slices(query)):
            hit = maybe & s
            n = int(np.bitwise_count(hit).sum())
            if n_sure + n > k:
                maybe = hit
                continue
            sure |= hit
            n_sure += n
            if n_sure == k:
                break
            maybe = maybe & ~s
        rows = positions(sure, n_sure)
        return rows if n_sure == k else rows + positions(maybe, k - n_sure)


class Block:
    """The rows of one group: bitmaps of the narrow ones, the wide ones beside them."""

    def __init__(self, rows: pa.Table, factor: int, k: int) -> None:
        x = matrix(rows.column("vec"))
        ids = rows.column("vec_id").to_numpy()
        wide = is_wide(x, factor)
        self.factor, self.k = factor, k
        self.ids, self.index = ids[~wide], BitSlices(whole(x[~wide], factor))
        self.wide_ids, self.wide = ids[wide].tolist(), whole(x[wide], factor).astype(object)

    def top(self, own: int, query: np.ndarray) -> list[tuple[int, int]]:
        """``(score, vec_id)`` of the ``k`` best rows of another id than ``own``, best first."""
        x, barred = self.index.x, slice(*np.searchsorted(self.ids, [own, own + 1]).tolist())
        beside = [(int(np.dot(v, query.astype(object))), i)
                  for v, i in zip(self.wide, self.wide_ids, strict=True) if i != own]
        if query.dtype == object:
            scores = x.astype(object) @ query if x.shape[1] else np.zeros(len(x), object)
            beside += [(int(s), i) for s, i in zip(scores.tolist(), self.ids.tolist(), strict=True) if i != own]
        else:
            rows = self.index.top(query.tolist(), self.k, barred)
            beside += zip((x[rows] @ query).tolist(), self.ids[rows].tolist(), strict=True)
        return heapq.nsmallest(self.k, beside, key=lambda pair: (-pair[0], pair[1]))

    def __call__(self, asked: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for batch in slices([asked], BATCH):
            q = matrix(batch.column("vec"))
            wide = is_wide(q, self.factor)
            out = []
            for i, (own, print_) in enumerate(zip(batch.column("vec_id").to_pylist(),
                                                  batch.column("print").to_pylist(), strict=True)):
                query = whole(q[i:i + 1], self.factor)[0]
                found = self.top(own, query.astype(object) if wide[i] else query)
                out += [(own, print_, i, order_key(s), as_long(s)) for s, i in found]
            if out:
                cols = zip(*out, strict=True)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                                 ["query_id", "print", "vec_id", "key", "score"])


def largest(vectors: DataFrame, vector: str = "embedding", k: int = K, query_step: int = QUERY_STEP,
            factor: int = FACTOR) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row whose ``vec_id`` is divisible by
    ``query_step`` the ``k`` rows (all, if fewer) with the largest inner product of
    ``floor(factor * x)``, exactly, ties to the smaller id; never a row of the query's own id.

    Rows with a null id and vectors that are null or hold a null or non-finite component take no
    part; vectors are compared with those of their own length, those of no components too (score 0).
    Equal rows count once. Rows that share an id but not the vector are each a candidate, and each a
    query of its own (so a ``query_id`` has as many rankings). A score that does not fit a long is
    null, its rank exact. Other columns are left out; an empty table gives no rows.
    """
    rows = usable(vectors, vector, "vec_id").filter(F.col("vec_id").isNotNull())
    rows = rows.withColumn("vec_id", F.col("vec_id").cast("long")).distinct()
    rows = materialise(rows, "slices-rows")
    asked = (rows.filter(F.col("vec_id") % query_step == 0)
             .withColumn("print", F.xxhash64("vec")))

    found = streamed_past(rows, asked, group_count(rows, GROUP_ROWS), lambda held: Block(held, factor, k),
                          "query_id long, print long, vec_id long, key binary, score long")
    best = Window.partitionBy("query_id", "print").orderBy(F.col("key").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
