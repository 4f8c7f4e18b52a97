"""Registered queries over what is stored: statistics kept up to date, bucketed and compacted archives,
many settings at once, and odd but readable lines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.format import epoch_millis
from ..functions.stats import MEAN, N, STDDEV, WINDOW_END, WINDOW_START
from ..operators.detect import detect
from ..operators.grid import SIGMA, WINDOW, detect_grid
from ..session import scratch_path
from ..sinks.lines import LINE, read_lines
from ..sources.readings import read_jsonl, to_readings
from ..streaming.detect_stream import detect_stream, start_to_lines
from .bucketed import bucketed_copy, detect_bucketed
from .oracle import anomaly_sql, closed, stats_sql
from .stats_store import StatsStore
from .stream_archive import StreamArchive
from .stream_queries import arrive_in_pieces

FOUND = ["event_type", WINDOW_START, "event_id", "ts", "value", N]
GRID_WINDOWS, GRID_SIGMAS = ("6 hours", "1 day", "7 days"), (2.0, 2.5, 3.0)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select("event_id", "ts", "event_type", "value")


def stats_store_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily statistics from a store that got the events in two batches, the first of them twice."""
    events = _readings(spark, sf_dir)
    store = StatsStore(spark, scratch_path(spark, "stats-store"), "event_type", "ts", "value", "1 day")
    for batch_id in (0, 1, 0):
        store.append(events.filter(F.col("event_id") % 2 == batch_id), batch_id)
    return store.read().select("event_type", WINDOW_START, WINDOW_END, N, F.round(MEAN, 6).alias(MEAN),
                               F.round(STDDEV, 6).alias(STDDEV), "lo", "hi")


def bucketed_archive_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anomalies over a bucketed archive, joined bucket by bucket as beyond the broadcast threshold."""
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    archived = bucketed_copy(spark, _readings(spark, sf_dir), "event_type", buckets)
    return detect_bucketed(archived, "event_type", "ts", "value", "1 day", 3.0,
                           stats_join="shuffle_hash").select(*FOUND)


def anomalies_grid_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anomalies of nine settings at once."""
    found = detect_grid(_readings(spark, sf_dir), "event_type", "ts", "value", GRID_WINDOWS, GRID_SIGMAS)
    return found.select(WINDOW, SIGMA, *FOUND)


def readings_forms_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as lines in every form that is read: numbers as text, times with a fraction, padded
    lines, with blank and comment lines between them."""
    events = _events(spark, sf_dir)
    readings = to_readings(events, F.concat_ws(":", "event_type", F.col("user_id").cast("string")), "value", "ts")
    # The object up to its closing brace, which the other fields follow.
    head = F.concat(F.rtrim(F.to_json(F.struct("deviceId")), F.lit("}")), F.lit(', "temperatureC": '))
    number, millis = F.col("temperatureC").cast("string"), F.col("timestampMillis").cast("string")
    quoted = [F.concat(F.lit('"'), c, F.lit('"')) for c in (number, millis)]

    def line(t, m):
        return F.concat(head, t, F.lit(', "timestampMillis": '), m, F.lit("}"))

    form = F.pmod(F.xxhash64("deviceId", "timestampMillis", "temperatureC"), F.lit(5))
    text = (F.when(form == 0, line(number, millis)).when(form == 1, line(quoted[0], quoted[1]))
            .when(form == 2, F.concat(F.lit(" \t"), line(number, F.concat(millis, F.lit(".0"))), F.lit("  ")))
            .when(form == 3, F.concat(F.lit("# a comment\n  # another\n"), line(quoted[0], millis)))
            .otherwise(F.concat(line(number, quoted[1]), F.lit("\n\n   \t"))))
    path = scratch_path(spark, "jsonl-forms")
    readings.select(text.alias("value")).write.text(path)
    return read_jsonl(spark, path, numbered=True).select("deviceId", "temperatureC", "timestampMillis")


def lines_streamed_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The anomaly lines of a stream as its tasks wrote them, a folder per micro-batch."""
    events = _readings(spark, sf_dir)
    src, out, checkpoint = (scratch_path(spark, f"lines-{p}") for p in ("in", "out", "ckpt"))
    files = arrive_in_pieces(events, src)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(src)
    found = detect_stream(stream, "event_type", "ts", "value", "1 day", 3.0)
    found = found.withColumn("millis", epoch_millis("ts", events.schema["ts"].dataType))
    query = start_to_lines(found, out, checkpoint, device_col="event_type", value_col="value", millis_col="millis")
    query.awaitTermination()
    return read_lines(spark, out).select(LINE)


def archive_compacted_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anomalies over a streamed archive: some dates merged, some merged again with later batches, the
    last batches as they came."""
    events = _readings(spark, sf_dir)
    src, checkpoint = scratch_path(spark, "archive-in"), scratch_path(spark, "archive-ckpt")
    archive = StreamArchive(spark, scratch_path(spark, "stream-archive"), events.schema)
    for part in range(3):
        events.filter(F.col("event_id") % 3 == part).write.mode("append").parquet(src)
        stream = spark.readStream.schema(events.schema).parquet(src)
        archive.append_stream(stream, checkpoint).awaitTermination()
        if part < 2:
            archive.compact()
    return detect(archive.read().drop("date"), "event_type", "ts", "value", "1 day", 3.0).select(*FOUND)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stats_store": stats_store_q,
    "bucketed_archive": bucketed_archive_q,
    "anomalies_grid": anomalies_grid_q,
    "readings_forms": readings_forms_q,
    "lines_streamed": lines_streamed_q,
    "archive_compacted": archive_compacted_q,
}

_ONE_LINE = ("'Device ' || event_type || ', measurement ' "
             "|| CAST(CAST(round(CAST(value AS DECIMAL(18, 6)), 1) AS DECIMAL(18, 1)) AS VARCHAR) "
             "|| ' C, time ' || CAST(epoch_us(ts) // 1000 AS VARCHAR)")

ORACLE_SQL: dict[str, str] = {
    "stats_store": stats_sql("1 day"),
    "bucketed_archive": anomaly_sql("event_type", "1 day", 3.0),
    "anomalies_grid": "\nUNION ALL\n".join(
        f"SELECT '{w}' AS \"window\", CAST({k} AS DOUBLE) AS k, g.* FROM ({anomaly_sql('event_type', w, k)}) g"
        for w in GRID_WINDOWS for k in GRID_SIGMAS),
    "readings_forms": """
SELECT event_type || ':' || CAST(user_id AS VARCHAR) AS deviceId, value AS temperatureC,
       epoch_us(ts) // 1000 AS timestampMillis
FROM events
""",
    "lines_streamed": f"""
WITH a AS ({anomaly_sql("event_type", "1 day", 3.0, extra=f"AND {closed('1 day')}")})
SELECT {_ONE_LINE} AS line FROM a
""",
    "archive_compacted": anomaly_sql("event_type", "1 day", 3.0),
}
