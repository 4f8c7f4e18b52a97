"""Windows that a stream has not closed yet, read from its checkpoint.

The statistics stream keeps one buffer of partial moments per open (keys, window). Spark's state data
source reads these buffers as a table while the query is stopped or running, as of its last committed
batch, so the open windows can be looked at without waiting for the watermark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.stats import HI, LO, M2, MEAN, N, STDDEV, WINDOW_END, WINDOW_START
from ..operators.windows import as_keys
from .detect_stream import _as_ntz

#: Buffers of the aggregates of ``moment_aggs`` in the order in which they are first used there:
#: the count; sum and count of the average; count, mean and squares of the variance; range.
_BUFFERS = ("count_n", "avg_sum", "avg_n", "var_n", "var_mean", "var_m2", "lo", "hi")


def open_windows(spark: SparkSession, checkpoint: str, keys: str | Sequence[str], ntz: bool = False,
                 batch_id: int | None = None) -> DataFrame:
    """``keys, window_start, window_end, n, mean, stddev, m2, lo, hi`` of the windows still open in
    the checkpoint of a :func:`window_stats_stream` query: after its last batch, or after ``batch_id``.

    ``ntz``: give the bounds as TIMESTAMP_NTZ, as that stream does for such event times. One task
    reads one state partition; nothing is gathered.
    """
    ks = as_keys(keys)
    reader = spark.read.format("statestore").option("path", checkpoint).option("operatorId", 0)
    if batch_id is not None:
        reader = reader.option("batchId", int(batch_id))
    state = reader.load()
    value = state.schema["value"].dataType
    if len(value.fields) != len(_BUFFERS):
        raise ValueError(f"not the state of window statistics: buffers {value.simpleString()}")
    # Buffers of different aggregates share names, so they are taken by position.
    named = T.StructType([T.StructField(n, f.dataType) for n, f in zip(_BUFFERS, value.fields, strict=True)])
    key = state.schema["key"].dataType
    at = {f.name: f for f in key.fields}
    missing = [k for k in ks if k not in at]
    if missing:
        raise ValueError(f"the state has no key {missing}; it has {key.names}")
    window = next(f.name for f in key.fields if isinstance(f.dataType, T.StructType))
    rows = state.select(F.col("key").alias("k"), F.col("value").cast(named).alias("v"))
    start, end = F.col(f"k.{window}.start"), F.col(f"k.{window}.end")
    if ntz:
        start, end = _as_ntz(start), _as_ntz(end)
    n = F.col("v.count_n")
    return rows.select(
        *[F.col("k").getField(k).alias(k) for k in ks], start.alias(WINDOW_START), end.alias(WINDOW_END),
        n.alias(N), (F.col("v.avg_sum") / F.col("v.avg_n")).alias(MEAN),
        F.sqrt(F.col("v.var_m2") / F.col("v.var_n")).alias(STDDEV), F.col("v.var_m2").alias(M2),
        F.col("v.lo").alias(LO), F.col("v.hi").alias(HI))
