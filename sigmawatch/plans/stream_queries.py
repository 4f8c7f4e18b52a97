"""Registered queries about the life of a stream: late rows, a restart, open windows, the end.

Each feeds the whole ``events`` table to a stream by files in the shared folder and gives what the
stream's sink or its checkpoint holds. The streams write with a checkpoint, so they run the same on a
cluster; nothing is gathered on the driver but a few boundaries and counters.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.format import epoch_millis
from ..functions.stats import MEAN, N, STDDEV, WINDOW_END, WINDOW_START
from ..session import scratch_path
from ..streaming.bounded import run_to_end
from ..streaming.detect_stream import detect_stream, start_to_files, window_stats_stream
from ..streaming.late import counting_late_rows
from ..streaming.open_windows import open_windows
from ..streaming.timers import detect_with_timers
from .oracle import anomaly_sql, bucket, closed, stats_sql

COLUMNS = ["event_id", "ts", "event_type", "value"]
FOUND = ["event_type", WINDOW_START, "event_id", "ts", "value", N]
WINDOW, DELAY = "1 day", "1 second"
#: Pieces in which the restarted stream's input arrives, and readings of one file of a piece.
PIECES = 6
FILE_ROWS = 1_000_000
#: One reading in this many comes in the second, late part.
LATE_STEP = 4


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").select(*COLUMNS)


def _stream(spark: SparkSession, like: DataFrame, path: str, files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(like.schema)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    return reader.parquet(path)


def _detect(stream: DataFrame) -> DataFrame:
    return detect_stream(stream, "event_type", "ts", "value", WINDOW, 3.0, DELAY).select(*FOUND)


def _ended(query: StreamingQuery) -> StreamingQuery:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return query


def _whole_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    path = scratch_path(spark, "stream-in")
    events.write.parquet(path)
    return _stream(spark, events, path)


def stream_late_dropped_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anomalies of a stream that gets one reading in four only after the others: those whose window
    has closed by then are late. ``late_rows``: how many were dropped over the whole run."""
    events = _events(spark, sf_dir)
    src, sink, checkpoint = (scratch_path(spark, f"late-{p}") for p in ("in", "out", "ckpt"))
    with counting_late_rows(spark) as counter:
        for late in (False, True):
            events.filter((F.col("event_id") % LATE_STEP == 0) == F.lit(late)).write.mode("append").parquet(src)
            found = _detect(_stream(spark, events, src))
            query = _ended(start_to_files(found, sink, checkpoint))
        dropped = counter.total(query)
    return spark.read.schema(found.schema).parquet(sink).withColumn("late_rows", F.lit(dropped).cast("long"))


def arrive_in_pieces(events: DataFrame, path: str, pieces: int = PIECES) -> int:
    """Write ``events`` to ``path`` piece by piece in order of time, each as the same number of files,
    which is returned."""
    at = epoch_millis("ts", events.schema["ts"].dataType)
    shares = [i / pieces for i in range(1, pieces)]
    about = events.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(at, shares, 10_000).alias("cuts")).first()
    files = max(1, about["n"] // (pieces * FILE_ROWS))
    cuts = [None, *(about["cuts"] or []), None]
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        piece = events
        if low is not None:
            piece = piece.filter(at >= low)
        if high is not None:
            piece = piece.filter(at < high)
        piece.repartition(files).write.mode("append").parquet(path)
    return files


def stop_after(query: StreamingQuery, batches: int, wait_seconds: float = 300.0) -> None:
    """Stop a running query once ``batches`` of its batches are done, wherever it then is."""
    until = time.monotonic() + wait_seconds
    while query.isActive and time.monotonic() < until:
        progress = query.lastProgress
        if progress and progress["batchId"] + 1 >= batches and progress["numInputRows"]:
            break
        time.sleep(0.05)
    query.stop()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def stream_restart_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anomalies of a stream that is stopped in the middle of its input and run again from its
    checkpoint: offsets, state and what the sink has committed are taken up where they stood."""
    events = _events(spark, sf_dir)
    src, sink, checkpoint = (scratch_path(spark, f"restart-{p}") for p in ("in", "out", "ckpt"))
    files = arrive_in_pieces(events, src)
    found = _detect(_stream(spark, events, src, files))
    stop_after(start_to_files(found, sink, checkpoint, available_now=False, processing_time="0 seconds"), 2)
    _ended(start_to_files(_detect(_stream(spark, events, src, files)), sink, checkpoint))
    return spark.read.schema(found.schema).parquet(sink)


def stream_open_windows_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of the windows that the stream has not closed, from the state in its checkpoint."""
    stream = _whole_stream(spark, sf_dir)
    stats = window_stats_stream(stream, "event_type", "ts", "value", WINDOW, DELAY)
    sink, checkpoint = scratch_path(spark, "open-out"), scratch_path(spark, "open-ckpt")
    _ended(start_to_files(stats, sink, checkpoint))
    ntz = isinstance(stream.schema["ts"].dataType, T.TimestampNTZType)
    still = open_windows(spark, checkpoint, "event_type", ntz=ntz)
    return still.select("event_type", WINDOW_START, WINDOW_END, N, F.round(MEAN, 6).alias(MEAN),
                        F.round(STDDEV, 6).alias(STDDEV), "lo", "hi")


def stream_flushed_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anomalies of a bounded stream, its last windows included: the stream alone gives what the
    batch gives."""
    stream = _whole_stream(spark, sf_dir)
    sink, checkpoint, clock = (scratch_path(spark, f"flush-{p}") for p in ("out", "ckpt", "clock"))
    run_to_end(stream, _detect, sink, checkpoint, clock, "ts", WINDOW, DELAY)
    return spark.read.schema(_detect(stream).schema).parquet(sink)


def stream_timers_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anomalies found by the stateful function with timers."""
    found = detect_with_timers(_whole_stream(spark, sf_dir), "event_type", "ts", "value", WINDOW, 3.0, DELAY)
    found = found.select(*FOUND)
    sink, checkpoint = scratch_path(spark, "timers-out"), scratch_path(spark, "timers-ckpt")
    _ended(start_to_files(found, sink, checkpoint))
    return spark.read.schema(found.schema).parquet(sink)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stream_late_dropped": stream_late_dropped_q,
    "stream_restart": stream_restart_q,
    "stream_open_windows": stream_open_windows_q,
    "stream_flushed": stream_flushed_q,
    "stream_timers": stream_timers_q,
}

_END = f"{bucket(WINDOW)} + INTERVAL '{WINDOW}'"
#: The watermark once the first part is through.
_MARK = f"(SELECT max(ts) - INTERVAL '{DELAY}' FROM events WHERE event_id % {LATE_STEP} <> 0)"
_LATE = f"event_id % {LATE_STEP} = 0 AND {_END} <= {_MARK}"

ORACLE_SQL: dict[str, str] = {
    "stream_late_dropped": anomaly_sql(
        "event_type", WINDOW, 3.0, where=f"WHERE NOT ({_LATE})", extra=f"AND {closed(WINDOW)}",
        more=f", (SELECT count(*) FROM events WHERE {_LATE}) AS late_rows"),
    "stream_restart": anomaly_sql("event_type", WINDOW, 3.0, extra=f"AND {closed(WINDOW)}"),
    "stream_open_windows": f"""
SELECT * FROM ({stats_sql(WINDOW)}) s
WHERE s.window_end > (SELECT max(ts) FROM events) - INTERVAL '{DELAY}'
""",
    "stream_flushed": anomaly_sql("event_type", WINDOW, 3.0),
    "stream_timers": anomaly_sql("event_type", WINDOW, 3.0, extra=f"AND {closed(WINDOW)}"),
}
