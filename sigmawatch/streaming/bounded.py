"""Bounded input as a stream that closes its last windows.

A stream's watermark follows the readings, so its last windows stay open until later data comes. A
bounded stream gets a second source, the clock: files of event times without readings. The clock's
rows pass the same watermark as the readings and hold null in every other column; they fall into a
window behind all others that never closes, so they add nothing to any result. Once the readings are
through, one clock row moves the watermark past the last window, and the stream itself emits it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.durations import duration_millis
from .detect_stream import DEFAULT_DELAY, start_to_files

_EPOCH = dt.datetime(1970, 1, 1)


def with_clock(readings: DataFrame, clock: str, time_col: str) -> DataFrame:
    """``readings`` (a stream) and the rows of the clock folder, null in all columns but the time.

    Apply the watermark to the result. Keys must accept null: a clock row is a reading of the null
    key without a value.
    """
    spark = readings.sparkSession
    field = readings.schema[time_col]
    schema = T.StructType([T.StructField(time_col, field.dataType)])
    # A source needs its folder: an empty file says nothing.
    spark.createDataFrame([], schema).write.mode("append").parquet(clock)
    ticks = spark.readStream.schema(schema).parquet(clock)
    return readings.unionByName(ticks.select(
        *[F.col(f.name) if f.name == time_col else F.lit(None).cast(f.dataType).alias(f.name)
          for f in readings.schema.fields]))


def tick(spark: SparkSession, clock: str, time_col: str, dtype: T.DataType, to: dt.datetime) -> None:
    """Add the event time ``to`` (UTC, without zone) to the clock folder."""
    micros = (to - _EPOCH) // dt.timedelta(microseconds=1)
    when = F.timestamp_micros(F.lit(micros))
    if isinstance(dtype, T.TimestampNTZType):
        when = F.timestamp_add("MICROSECOND", F.lit(micros), F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))
    spark.range(1).select(when.alias(time_col)).write.mode("append").parquet(clock)


def watermark(query: StreamingQuery) -> dt.datetime | None:
    """The watermark of the query's last batch (UTC, without zone); None before the first reading."""
    progress = query.lastProgress
    text = (progress or {}).get("eventTime", {}).get("watermark")
    if not text:
        return None
    at = dt.datetime.fromisoformat(text.replace("Z", "+00:00")).astimezone(dt.timezone.utc)
    at = at.replace(tzinfo=None)
    return None if at == _EPOCH else at


def _finished(query: StreamingQuery) -> StreamingQuery:
    query.awaitTermination()
    return query


def run_to_end(readings: DataFrame, apply: Callable[[DataFrame], DataFrame], path: str, checkpoint: str,
               clock: str, time_col: str, window: str, delay: str = DEFAULT_DELAY) -> StreamingQuery:
    """Run ``apply`` over a bounded stream of ``readings`` to its end, last windows included.

    ``apply`` turns the stream (readings and clock) into the stream that is written to ``path``, such
    as :func:`detect_stream` with the same ``window`` and ``delay``. The first run takes all readings
    that are there; then the clock moves by a window and the delay, which lies behind the end of
    every open window, and a second run on the same checkpoint emits them. Readings older than that
    are late from then on. Without any reading nothing is emitted. Returns the last run.
    """
    spark = readings.sparkSession

    def run() -> StreamingQuery:
        return _finished(start_to_files(apply(with_clock(readings, clock, time_col)), path, checkpoint))

    query = run()
    reached = watermark(query)
    if reached is None:
        return query
    # No reading is later than the watermark plus the delay, so no open window ends behind this plus
    # the window's size; the watermark follows the clock at the delay's distance. Watermarks count
    # whole milliseconds.
    step = duration_millis(window) + 2 * duration_millis(delay) + 1
    tick(spark, clock, time_col, readings.schema[time_col].dataType, reached + dt.timedelta(milliseconds=step))
    return run()
