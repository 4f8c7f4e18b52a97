"""Registered queries over the driver tables, each with its DuckDB oracle SQL.

``events(event_id, ts TIMESTAMP_NTZ, user_id, event_type, value, props)`` plays the reading
table: key ``event_type`` (or ``user_id``), value ``value``, event time ``ts``. At one-minute
windows those keys are too sparse to ever flag a reading, so the queries use day and week
windows. Every query reads whole tables; none caps, samples or filters rows to be cheap.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.format import epoch_millis
from ..functions.stats import MEAN, N, STDDEV, WINDOW_END, WINDOW_START
from ..operators.detect import detect, flag_counts
from ..operators.merge import merge_stats
from ..operators.windows import window_stats
from ..session import scratch_path
from ..sinks.lines import LINE, with_lines, write_lines
from ..sources.readings import read_jsonl, to_readings, write_jsonl
from ..streaming.detect_stream import detect_stream, start_to_files, window_stats_stream
from .archive import archive_readings, replay
from .oracle import anomaly_sql, bucket, stats_sql
from .store_queries import ORACLE_SQL as STORE_SQL
from .store_queries import QUERIES as STORE_QUERIES
from .stream_queries import ORACLE_SQL as STREAM_SQL
from .stream_queries import QUERIES as STREAM_QUERIES

ANOMALY_COLS = ["event_type", WINDOW_START, "event_id", "ts", "value", N]


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def _anomalies(key: str, window: str, k: float, method: str = "incremental"):
    cols = [c if c != "event_type" else key for c in ANOMALY_COLS]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ev = _events(spark, sf_dir).select("event_id", "ts", key, "value")
        return detect(ev, key, "ts", "value", window, k, method).select(*cols)
    return run


def window_stats_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = window_stats(_events(spark, sf_dir), "event_type", "ts", "value", "1 day")
    return st.select("event_type", WINDOW_START, WINDOW_END, N, F.round(MEAN, 6).alias(MEAN),
                     F.round(STDDEV, 6).alias(STDDEV), "lo", "hi")


def merge_stats_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = window_stats(_events(spark, sf_dir), "event_type", "ts", "value", "1 day")
    weekly = merge_stats(daily, "event_type", "7 days")
    return weekly.select("event_type", WINDOW_START, WINDOW_END, N, F.round(MEAN, 6).alias(MEAN),
                         F.round(STDDEV, 6).alias(STDDEV), "lo", "hi")


def merge_hours_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly = window_stats(_events(spark, sf_dir), "event_type", "ts", "value", "1 hour")
    daily = merge_stats(hourly, "event_type", "1 day")
    return daily.select("event_type", WINDOW_START, WINDOW_END, N, F.round(MEAN, 6).alias(MEAN),
                        F.round(STDDEV, 6).alias(STDDEV), "lo", "hi")


def constant_guard_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Every reading of an event type carries the same value: all windows have zero spread.
    ev = _events(spark, sf_dir).select(
        "event_type", "ts", (F.length("event_type") * F.lit(0.1)).alias("value"))
    return flag_counts(ev, "event_type", "ts", "value", "1 day", 3.0)


def anomaly_lines_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir).select("event_id", "ts", "event_type", "value")
    found = detect(ev, "event_type", "ts", "value", "1 day", 3.0)
    found = found.withColumn("millis", epoch_millis("ts", T.TimestampNTZType()))
    return with_lines(found, "event_type", "value", "millis").select("event_id", LINE)


def lines_written_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The anomaly lines as the file sink wrote them."""
    ev = _events(spark, sf_dir).select("event_id", "ts", "event_type", "value")
    found = detect(ev, "event_type", "ts", "value", "1 day", 3.0)
    path = scratch_path(spark, "lines")
    write_lines(found.select(F.col("event_type").alias("deviceId"),
                             F.col("value").alias("temperatureC"),
                             epoch_millis("ts", T.TimestampNTZType()).alias("timestampMillis")), path)
    return spark.read.text(path).withColumnRenamed("value", LINE)


def readings_parse_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir)
    readings = to_readings(ev, F.concat_ws(":", "event_type", F.col("user_id").cast("string")),
                           "value", "ts")
    path = scratch_path(spark, "jsonl")
    write_jsonl(readings, path, header="readings exported from events")
    return read_jsonl(spark, path).select("deviceId", "temperatureC", "timestampMillis")


def _events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream: written once to the shared folder, then read back."""
    ev = _events(spark, sf_dir).select("event_id", "ts", "event_type", "value")
    src = scratch_path(spark, "stream-in")
    ev.write.parquet(src)
    return spark.readStream.schema(ev.schema).parquet(src)


def _run_to_table(spark: SparkSession, stream: DataFrame) -> DataFrame:
    sink, ckpt = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    query = start_to_files(stream, sink, ckpt)
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return spark.read.schema(stream.schema).parquet(sink)


def stream_anomalies_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detect_stream(_events_stream(spark, sf_dir), "event_type", "ts", "value", "1 day", 3.0,
                          "1 second")
    return _run_to_table(spark, found.select(*ANOMALY_COLS))


def stream_window_stats_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = window_stats_stream(_events_stream(spark, sf_dir), "event_type", "ts", "value", "1 day",
                             "1 second")
    table = _run_to_table(spark, st)
    return table.select("event_type", WINDOW_START, WINDOW_END, N, F.round(MEAN, 6).alias(MEAN),
                        F.round(STDDEV, 6).alias(STDDEV), "lo", "hi")


def replay_backfill_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archive")
    archive_readings(_events(spark, sf_dir).select("event_id", "ts", "event_type", "value"), path)
    found = replay(spark, path, "2024-01-08", "2024-01-21", "event_type", "ts", "value",
                   "1 day", 2.5)
    return found.select(*ANOMALY_COLS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "anomalies_incremental": _anomalies("event_type", "1 day", 3.0, "incremental"),
    "anomalies_two_pass": _anomalies("event_type", "1 day", 3.0, "two_pass"),
    "anomalies_weekly": _anomalies("event_type", "7 days", 3.0),
    "anomalies_by_user": _anomalies("user_id", "7 days", 3.0),
    "anomalies_sigma2": _anomalies("event_type", "1 day", 2.0),
    "anomalies_hourly": _anomalies("event_type", "1 hour", 3.0),
    "anomalies_hourly_sigma2": _anomalies("event_type", "1 hour", 2.0),
    "anomalies_6h": _anomalies("event_type", "6 hours", 3.0),
    "window_stats": window_stats_q,
    "merge_stats": merge_stats_q,
    "merge_hours": merge_hours_q,
    "constant_guard": constant_guard_q,
    "anomaly_lines": anomaly_lines_q,
    "lines_written": lines_written_q,
    "readings_parse": readings_parse_q,
    "stream_anomalies": stream_anomalies_q,
    "stream_window_stats": stream_window_stats_q,
    "replay_backfill": replay_backfill_q,
    **STREAM_QUERIES,
    **STORE_QUERIES,
}


# ---- DuckDB oracles ---------------------------------------------------------------------------

ORACLE_SQL: dict[str, str] = {
    "anomalies_incremental": anomaly_sql("event_type", "1 day", 3.0),
    "anomalies_two_pass": anomaly_sql("event_type", "1 day", 3.0),
    "anomalies_weekly": anomaly_sql("event_type", "7 days", 3.0),
    "anomalies_by_user": anomaly_sql("user_id", "7 days", 3.0),
    "anomalies_sigma2": anomaly_sql("event_type", "1 day", 2.0),
    "anomalies_hourly": anomaly_sql("event_type", "1 hour", 3.0),
    "anomalies_hourly_sigma2": anomaly_sql("event_type", "1 hour", 2.0),
    "anomalies_6h": anomaly_sql("event_type", "6 hours", 3.0),
    "window_stats": stats_sql("1 day"),
    "merge_stats": stats_sql("7 days"),
    "merge_hours": stats_sql("1 day"),
    "constant_guard": f"""
WITH b AS (
  SELECT event_type, length(event_type) * 0.1 AS value, {bucket('1 day')} AS window_start FROM events
), s AS (
  SELECT event_type AS s_key, window_start AS s_ws, count(value) AS n, avg(value) AS mean,
         stddev_pop(value) AS sd, min(value) AS lo, max(value) AS hi
  FROM b GROUP BY ALL
)
SELECT s.s_key AS event_type, s.s_ws AS window_start, s.n AS n,
       CAST(sum(CASE WHEN s.n >= 2 AND s.hi > s.lo AND abs(b.value - s.mean) > 3.0 * s.sd
                     THEN 1 ELSE 0 END) AS BIGINT) AS n_flagged
FROM b JOIN s ON b.event_type = s.s_key AND b.window_start = s.s_ws
GROUP BY s.s_key, s.s_ws, s.n
""",
    "anomaly_lines": f"""
WITH a AS ({anomaly_sql("event_type", "1 day", 3.0)})
SELECT event_id,
       'Device ' || event_type || ', measurement '
       || CAST(CAST(round(CAST(value AS DECIMAL(18, 6)), 1) AS DECIMAL(18, 1)) AS VARCHAR)
       || ' C, time ' || CAST(epoch_us(ts) // 1000 AS VARCHAR) AS line
FROM a
""",

    "lines_written": f"""
WITH a AS ({anomaly_sql("event_type", "1 day", 3.0)})
SELECT 'Device ' || event_type || ', measurement '
       || CAST(CAST(round(CAST(value AS DECIMAL(18, 6)), 1) AS DECIMAL(18, 1)) AS VARCHAR)
       || ' C, time ' || CAST(epoch_us(ts) // 1000 AS VARCHAR) AS line
FROM a
""",
    "readings_parse": """
SELECT event_type || ':' || CAST(user_id AS VARCHAR) AS deviceId, value AS temperatureC,
       epoch_us(ts) // 1000 AS timestampMillis
FROM events
""",
    "stream_anomalies": anomaly_sql(
        "event_type", "1 day", 3.0,
        extra="AND b.window_start + INTERVAL '1 day' <= "
              "(SELECT max(ts) FROM events) - INTERVAL '1 second'"),
    "stream_window_stats": f"""
SELECT * FROM ({stats_sql("1 day")}) s
WHERE s.window_end <= (SELECT max(ts) FROM events) - INTERVAL '1 second'
""",
    "replay_backfill": anomaly_sql(
        "event_type", "1 day", 2.5,
        where="WHERE ts >= TIMESTAMP '2024-01-08 00:00:00' AND ts < TIMESTAMP '2024-01-22 00:00:00'"),
    **STREAM_SQL,
    **STORE_SQL,
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly outliers per event type (the reference's job on the driver's reading table)."""
    return QUERIES["anomalies_weekly"](spark, sf_dir)
