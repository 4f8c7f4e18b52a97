"""Vectors as exact integers, integers that sort as bytes, and queries streamed past groups of rows.

Components become ``floor(factor * x)``. They are int64 where every sum of products fits that type
(:func:`narrow`); larger ones are Python integers of any size, so no finite component overflows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import shuffle_partitions

#: Components of one group of rows: what a task holds of the table.
GROUP_CELLS = 4 << 20
#: Rows of a group are not fewer than this only to keep more cores busy.
MIN_GROUP_ROWS = 4_096


def usable(df: DataFrame, vector: str, *kept: str) -> DataFrame:
    """``kept`` columns and ``vec`` of the rows whose vector is not null and holds no null, infinite
    or NaN component. Float vectors stay float, so that they are no wider than their table's."""
    kind = df.schema[vector].dataType.elementType
    vec = F.col(vector) if isinstance(kind, (T.FloatType, T.DoubleType)) else F.col(vector).cast("array<double>")
    good = F.forall("vec", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    return df.select(*[F.col(k) for k in kept], vec.alias("vec")).filter(F.col("vec").isNotNull()).filter(good)


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of an Arrow column of lists of one length, as doubles."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(lists), len(flat) // max(1, len(lists)))


def narrow(dims: int) -> int:
    """Bound on a component's size below which squared distances and inner products of ``dims``
    components stay below 2**62."""
    return 1 << (30 - (max(1, dims).bit_length() + 1) // 2)


def is_wide(x: np.ndarray, factor: int) -> np.ndarray:
    """Which rows have a component whose integer reaches :func:`narrow`."""
    with np.errstate(over="ignore"):
        return (np.abs(np.floor(x * factor)) >= narrow(x.shape[1])).any(1)


def whole(x: np.ndarray, factor: int) -> np.ndarray:
    """``floor(factor * x)`` exactly, for a power of two: int64, or Python integers (dtype object)
    where a component reaches :func:`narrow`."""
    if not is_wide(x, factor).any():
        return np.floor(x * factor).astype(np.int64)
    # A double of 2**52 and more is an integer; smaller ones do not overflow when multiplied.
    exact = [math.floor(v * factor) if abs(v) < 2**52 else int(v) * factor for v in x.ravel().tolist()]
    out = np.empty(len(exact), object)
    out[:] = exact
    return out.reshape(x.shape)


def order_key(value: int) -> bytes:
    """Bytes that sort as the integers do: sign, length, magnitude; inverted below zero."""
    size = (abs(value).bit_length() + 7) // 8
    body = size.to_bytes(2, "big") + abs(value).to_bytes(size, "big")
    return b"\x01" + body if value >= 0 else b"\x00" + bytes(255 - b for b in body)


def from_key(key: bytes) -> int:
    if key[0]:
        return int.from_bytes(key[3:], "big")
    return -int.from_bytes(bytes(255 - b for b in key[3:]), "big")


def as_long(value: int) -> int | None:
    """The integer where it fits a long column, else null."""
    return value if -(1 << 63) <= value < 1 << 63 else None


def group_count(rows: DataFrame, least: int | None = None) -> int:
    """Number of groups that ``rows`` (with ``vec``) are dealt to: enough that a group holds about
    :data:`GROUP_CELLS` components, and one per shuffle partition where the rows suffice for
    ``least`` a group (:data:`MIN_GROUP_ROWS`)."""
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.size("vec")), F.lit(0)).alias("cells")).first()
    busy = min(shuffle_partitions(rows.sparkSession), size["n"] // (least or MIN_GROUP_ROWS))
    return max(1, -(-size["cells"] // GROUP_CELLS), busy)


def streamed_past(rows: DataFrame, asked: DataFrame, groups: int,
                  answer: Callable[[pa.Table], Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]]],
                  schema: str, group: str | None = None) -> DataFrame:
    """Every row of ``asked`` meets every row of ``rows`` of its own number of components.

    ``rows`` (with ``vec_id`` and ``vec``) are dealt to ``groups``, evenly by a hash of the whole row
    or as the column ``group`` says (from 0), and shuffled once; ``asked`` is sent to each group. In a group's task the rows come first, in order of
    ``vec_id`` within ``dim``; ``answer(rows)`` turns them into what is held, a function that is then
    given ``asked`` batch by batch. So a task holds one group and one batch, however many are asked.
    """
    names = sorted((set(rows.columns) | set(asked.columns)) - {"vec"})
    types = {f.name: f.dataType for df in (rows, asked) for f in df.schema.fields}

    def shaped(df: DataFrame, group, kind: int) -> DataFrame:
        cols = [F.col(n) if n in df.columns else F.lit(None).cast(types[n]).alias(n) for n in names]
        return df.select(group.alias("_group"), F.size("vec").alias("_dim"), F.lit(kind).alias("_kind"),
                         *cols, "vec")

    spread = F.col(group) if group else F.pmod(F.xxhash64(*rows.columns), F.lit(groups))
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    both = shaped(rows, spread.cast("int"), 0).unionByName(shaped(asked, everywhere, 1))
    dealt = (both.repartitionById(groups, "_group")
             .sortWithinPartitions("_group", "_dim", "_kind", "vec_id", "vec"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held, ask = None, [], None
        for batch in batches:
            marks = [batch.column(n).to_numpy(zero_copy_only=False) for n in ("_group", "_dim", "_kind")]
            steps = np.any([m[1:] != m[:-1] for m in marks], axis=0)
            cuts = [0, *(np.flatnonzero(steps) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if lo == hi:
                    continue
                here, kind = (int(marks[0][lo]), int(marks[1][lo])), int(marks[2][lo])
                if here != place:
                    place, held, ask = here, [], None
                if kind == 0:
                    held.append(batch.slice(lo, hi - lo))
                    continue
                if ask is None and held:
                    ask, held = answer(pa.Table.from_batches(held)), []
                if ask is not None:
                    yield from ask(batch.slice(lo, hi - lo))

    return dealt.mapInArrow(run, schema)
