"""Raw reading archive (parquet, partitioned by UTC date) and replay/backfill over it.

Replay re-runs detection over archived readings with other settings (window, k, shape). Reads are
pruned to the dates that cover whole windows of the requested range, so a multi-day window at the
edge of the range is computed from all of its readings, never from a cut.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.durations import duration_millis
from ..functions.stats import DEFAULT_K, WINDOW_END, WINDOW_START
from ..operators.detect import detect

DATE_COL = "date"


def utc_date(df: DataFrame, time_col: str):
    """UTC calendar date of an event-time column (TIMESTAMP, TIMESTAMP_NTZ or epoch millis)."""
    dtype = df.schema[time_col].dataType
    c = F.col(time_col)
    if isinstance(dtype, T.TimestampNTZType):
        return F.to_date(c)
    if isinstance(dtype, T.TimestampType):
        return F.date_from_unix_date(F.floor(F.unix_micros(c) / F.lit(86_400_000_000)).cast("int"))
    return F.date_from_unix_date(F.floor(c.cast("long") / F.lit(86_400_000)).cast("int"))


def archive_readings(readings: DataFrame, path: str, time_col: str = "ts",
                     mode: str = "append", max_records_per_file: int = 5_000_000) -> None:
    """Append readings to a parquet archive partitioned by UTC ``date``.

    The rows are rebalanced by date first: adaptive execution joins small dates in one task and
    splits a hot date over several, so the number of files follows the data, not tasks x dates.
    """
    (readings.withColumn(DATE_COL, utc_date(readings, time_col))
     .hint("rebalance", DATE_COL)
     .sortWithinPartitions(DATE_COL)
     .write.mode(mode).option("maxRecordsPerFile", int(max_records_per_file))
     .partitionBy(DATE_COL).parquet(path))


def archive_stream(readings: DataFrame, path: str, checkpoint: str, time_col: str = "ts",
                   available_now: bool = False) -> StreamingQuery:
    """Continuously archive a reading stream (exactly-once file sink with a checkpoint)."""
    writer = (readings.withColumn(DATE_COL, utc_date(readings, time_col))
              .writeStream.format("parquet").option("path", path)
              .option("checkpointLocation", checkpoint).partitionBy(DATE_COL).outputMode("append"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def replay(spark: SparkSession, path: str, start: str | dt.date, end: str | dt.date,
           keys: str | Sequence[str], time_col: str, value_col: str, window: str = "1 minute",
           k: float = DEFAULT_K, method: str = "incremental") -> DataFrame:
    """Anomalies of every window that overlaps the UTC dates ``[start, end]`` of the archive."""
    start_d = dt.date.fromisoformat(str(start))
    end_d = dt.date.fromisoformat(str(end))
    if end_d < start_d:
        raise ValueError("end is before start")
    size = duration_millis(window)
    epoch = dt.datetime(1970, 1, 1)
    lo_ms = (dt.datetime.combine(start_d, dt.time()) - epoch) // dt.timedelta(milliseconds=1)
    hi_ms = (dt.datetime.combine(end_d + dt.timedelta(days=1), dt.time()) - epoch) // dt.timedelta(milliseconds=1)
    # Whole windows: from the start of the first window to the end of the last one.
    scan_lo = lo_ms - lo_ms % size
    scan_hi = hi_ms + (-hi_ms) % size
    first_day = epoch + dt.timedelta(milliseconds=scan_lo)
    last_day = epoch + dt.timedelta(milliseconds=scan_hi - 1)
    archived = spark.read.parquet(path).filter(
        (F.col(DATE_COL) >= F.lit(first_day.date())) & (F.col(DATE_COL) <= F.lit(last_day.date())))
    found = detect(archived.drop(DATE_COL), keys, time_col, value_col, window, k, method)
    ws, we = F.col(WINDOW_START), F.col(WINDOW_END)
    if isinstance(archived.schema[time_col].dataType, T.TimestampNTZType):
        range_lo = F.lit(f"{start_d.isoformat()} 00:00:00").cast("timestamp_ntz")
        range_hi = F.lit(f"{(end_d + dt.timedelta(days=1)).isoformat()} 00:00:00").cast("timestamp_ntz")
    else:
        ws, we = F.unix_micros(ws), F.unix_micros(we)
        range_lo, range_hi = F.lit(lo_ms * 1000), F.lit(hi_ms * 1000)
    return found.filter((we > range_lo) & (ws < range_hi))
