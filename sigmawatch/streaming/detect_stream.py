"""Outlier detection on Structured Streaming input.

Two stateful operators over the same watermarked stream:

1. a windowed aggregate of the moments per (keys, window), emitted in append mode once the
   watermark passes the window end (state: one buffer of partial moments per open group);
2. a stream-stream inner join of those statistics (only groups holding an outlier) with the
   readings on (keys, window, salt). The readings wait in the join's state store row by row
   (RocksDB-backed when the session selects that provider), not as one growing array per group,
   spread over ``salt_buckets`` state partitions per group, and both sides' state is evicted by
   the watermark once the window has been emitted.

A window fires when ``max event time - delay >= window end``; rows older than the watermark are
dropped (``numRowsDroppedByWatermark``). The last windows of a stream stay open until later data
moves the watermark: for bounded input use the batch :func:`sigmawatch.operators.detect`, which
closes every window. Results are written with a checkpoint location, so a restarted query
resumes from its committed offsets and state.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.stats import (
    DEFAULT_K, HI, LO, M2, WINDOW_END, WINDOW_START, deviates, group_can_flag, moment_aggs,
    tumbling_window,
)
from ..operators.windows import as_keys, check_columns

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
DEFAULT_DELAY = "1 second"
DEFAULT_SALT = 8


def _event_time(df: DataFrame, time_col: str) -> tuple[DataFrame, str, bool]:
    """A private TIMESTAMP copy of the event time, ``__et``, to carry the watermark.

    The caller's own time column stays a plain column, so a stream may select it next to the
    window without holding two event-time columns. TIMESTAMP_NTZ is read as UTC wall-clock
    time, so windows align with the batch path whatever the session zone."""
    dtype = df.schema[time_col].dataType
    if isinstance(dtype, T.TimestampType):
        return df.withColumn("__et", F.col(time_col)), "__et", False
    if isinstance(dtype, T.TimestampNTZType):
        micros = F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), F.col(time_col))
        return df.withColumn("__et", F.timestamp_micros(micros)), "__et", True
    raise TypeError(f"event time must be a timestamp, got {dtype.simpleString()}")


def _as_ntz(c: Column) -> Column:
    """TIMESTAMP instant -> TIMESTAMP_NTZ of its UTC wall-clock time."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), F.expr(_EPOCH_NTZ))


_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def ensure_disk_state(spark) -> None:
    """Use RocksDB for streaming state where the session still has Spark's default, which keeps
    every open window's readings on the executors' heap. A provider that was chosen stays."""
    if spark.conf.get(_PROVIDER).endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(_PROVIDER, _ROCKSDB)


def window_stats_stream(readings: DataFrame, keys: str | Sequence[str], time_col: str,
                        value_col: str, window: str = "1 minute",
                        delay: str = DEFAULT_DELAY) -> DataFrame:
    """Per (keys, window) moments of a stream, one row per window after it closes; columns as
    :func:`sigmawatch.operators.window_stats` (``keys, window_start, window_end, n, mean, ...``).
    The state is one partial-moment buffer per open group, whatever the number of readings."""
    ks = as_keys(keys)
    check_columns(readings, ks, time_col, value_col)
    df, et, ntz = _event_time(readings, time_col)
    df = df.withWatermark(et, delay)
    w = tumbling_window(et, window).alias("__swin")
    stats = df.groupBy(w, *[F.col(c) for c in ks]).agg(*moment_aggs(value_col))
    start, end = F.col("__swin.start"), F.col("__swin.end")
    if ntz:
        start, end = _as_ntz(start), _as_ntz(end)
    return stats.select(*ks, start.alias(WINDOW_START), end.alias(WINDOW_END),
                        *[c for c in stats.columns if c != "__swin" and c not in ks])


def detect_stream(readings: DataFrame, keys: str | Sequence[str], time_col: str, value_col: str,
                  window: str = "1 minute", k: float = DEFAULT_K,
                  delay: str = DEFAULT_DELAY, salt_buckets: int = DEFAULT_SALT) -> DataFrame:
    """Streaming twin of :func:`sigmawatch.operators.detect` (append mode).

    Returns the input columns of flagged readings plus ``window_start, window_end, n, mean,
    stddev``; for TIMESTAMP_NTZ event time the window bounds are TIMESTAMP_NTZ as in batch.

    ``salt_buckets``: the readings wait in the join state under (keys, window, salt), the salt
    a hash of the reading's columns, and each statistics row (one per group) is copied to every
    salt. A hot group's buffered readings therefore spread over that many state partitions
    instead of one; the output is the same for any value.
    """
    if not readings.isStreaming:
        raise ValueError("batch input: use sigmawatch.operators.detect")
    if int(salt_buckets) < 1:
        raise ValueError("salt_buckets must be >= 1")
    ks = as_keys(keys)
    check_columns(readings, ks, time_col, value_col)
    df, et, ntz = _event_time(readings, time_col)
    df = df.withWatermark(et, delay)
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in readings.columns]), F.lit(int(salt_buckets)))
    left = df.withColumn("__win", tumbling_window(et, window)).withColumn("__salt", salt)
    stats = (df.groupBy(tumbling_window(et, window).alias("__swin"),
                        *[F.col(c).alias(f"__s_{c}") for c in ks])
             .agg(*moment_aggs(value_col)).drop(M2)
             .filter(group_can_flag(k)).drop(LO, HI)
             .withColumn("__s_salt", F.explode(F.sequence(F.lit(0).cast("long"),
                                                          F.lit(int(salt_buckets) - 1).cast("long")))))
    cond = reduce(lambda a, b: a & b,
                  [left["__win"] == stats["__swin"], left["__salt"] == stats["__s_salt"]]
                  + [left[c].eqNullSafe(stats[f"__s_{c}"]) for c in ks])
    joined = left.join(stats, cond, "inner").filter(deviates(value_col, k))
    start, end = F.col("__win.start"), F.col("__win.end")
    if ntz:
        start, end = _as_ntz(start), _as_ntz(end)
    out = joined.select(*readings.columns, start.alias(WINDOW_START), end.alias(WINDOW_END),
                        *[c for c in stats.columns if c not in ("__swin", LO, HI)
                          and not c.startswith("__s_")])
    return out


def start_to_files(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                   available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Start an append-mode file sink with a checkpoint (exactly-once output, restartable)."""
    ensure_disk_state(stream.sparkSession)
    writer = (stream.writeStream.format(fmt).option("path", path)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def start_to_console(stream: DataFrame, checkpoint: str, available_now: bool = False,
                     processing_time: str | None = None, out=None, **line_cols) -> StreamingQuery:
    """Print each micro-batch's anomaly lines (the reference's console sink) via ``foreachBatch``.

    ``line_cols`` name the device, value and millis columns (see :func:`sinks.lines.with_lines`).
    """
    from ..sinks.lines import console_batch_writer

    ensure_disk_state(stream.sparkSession)
    writer = (stream.writeStream.foreachBatch(console_batch_writer(out=out, **line_cols))
              .option("checkpointLocation", checkpoint).outputMode("append"))
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def start_to_lines(stream: DataFrame, path: str, checkpoint: str, available_now: bool = True,
                   processing_time: str | None = None, **line_cols) -> StreamingQuery:
    """Write each micro-batch's anomaly lines below ``path`` (see :func:`sinks.lines.line_batch_writer`):
    from the tasks, each line once however often a batch is run."""
    from ..sinks.lines import line_batch_writer

    ensure_disk_state(stream.sparkSession)
    writer = (stream.writeStream.foreachBatch(line_batch_writer(path, **line_cols))
              .option("checkpointLocation", checkpoint).outputMode("append"))
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def rows_dropped_by_watermark(query: StreamingQuery) -> int:
    """Late rows dropped, from the query's recent progress (its last hundred batches; for a whole run
    see :func:`sigmawatch.streaming.counting_late_rows`). A batch counts by its largest operator, as
    every stateful operator drops the same late row; an aggregate counts rows that its map tasks have
    already combined per group, a join single readings."""
    total = 0
    for progress in query.recentProgress:
        ops = progress.get("stateOperators") or []
        if ops:
            total += max(int(op.get("numRowsDroppedByWatermark", 0) or 0) for op in ops)
    return total
