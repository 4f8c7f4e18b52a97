"""Streaming detection: window firing, late data, stream = batch, restart from a checkpoint."""

from __future__ import annotations

import os

import pytest
from conftest import SAMPLE_LINE, fresh_dir, jsonl, sample_rows, sample_text
from pyspark.sql import functions as F

from sigmawatch.operators import detect, window_stats
from sigmawatch.sinks.lines import LINE, console_batch_writer, with_lines
from sigmawatch.sources import read_jsonl_stream
from sigmawatch.streaming import (
    detect_stream, rows_dropped_by_watermark, start_to_files, window_stats_stream,
)


class Feed:
    """A folder fed with JSON-lines files, one per step, and a restartable detection query."""

    def __init__(self, spark):
        self.spark = spark
        root = fresh_dir("sw-stream-")
        self.src, self.out, self.ckpt = (os.path.join(root, p) for p in ("in", "out", "ckpt"))
        os.makedirs(self.src)
        self.files = 0

    def put(self, text):
        self.files += 1
        tmp = os.path.join(self.src, f".{self.files:04d}.tmp")
        with open(tmp, "w") as f:
            f.write(text)
        os.rename(tmp, os.path.join(self.src, f"{self.files:04d}.jsonl"))

    def run(self):
        stream = read_jsonl_stream(self.spark, self.src, max_files_per_trigger=1)
        found = detect_stream(stream, "deviceId", "ts", "temperatureC", "1 minute", 3.0)
        q = start_to_files(with_lines(found).select(LINE), self.out, self.ckpt, fmt="parquet")
        q.awaitTermination()
        assert q.exception() is None
        return q

    def lines(self):
        if not os.path.exists(self.out):
            return []
        return sorted(r[LINE] for r in self.spark.read.parquet(self.out).collect())


def test_flush_and_late_row(spark):
    feed = Feed(spark)
    feed.put(sample_text())
    feed.run()
    assert feed.lines() == []                       # last window stays open at end of input
    feed.put(jsonl([("sensor-C", 1.0, 120999)]))
    feed.run()
    assert feed.lines() == []                       # watermark 119999 < window end 120000
    feed.put(jsonl([("sensor-C", 1.0, 121000)]))
    feed.run()
    assert feed.lines() == [SAMPLE_LINE]            # watermark reaches the end: window fires
    feed.put(jsonl([("sensor-A", 1.0, 60001)]))
    q = feed.run()
    assert rows_dropped_by_watermark(q) == 1        # behind the watermark: dropped
    assert feed.lines() == [SAMPLE_LINE]


def test_restart_resumes_from_checkpoint(spark):
    feed = Feed(spark)
    feed.put(sample_text())
    feed.run()                                      # query stops with the window still open
    feed.put(jsonl([("sensor-C", 1.0, 200000)]))
    feed.run()                                      # a new query on the same checkpoint
    assert feed.lines() == [SAMPLE_LINE]            # state was restored, output exactly once
    feed.run()
    assert feed.lines() == [SAMPLE_LINE]


def test_stream_equals_batch_on_closed_windows(spark):
    from datamaker import generate_readings
    readings = generate_readings(spark, 40, 30, 60000, 4, 0.3, 13)
    root = fresh_dir("sw-sb-")
    src = os.path.join(root, "in")
    # Time-ordered files: one per window, as a producer would append them.
    for w in range(4):
        part = readings.filter((F.col("timestampMillis") / 60000).cast("int") == w)
        part.coalesce(1).write.mode("append").json(src)
    stream = spark.readStream.schema(readings.schema).option("maxFilesPerTrigger", 1).json(src)
    stream = stream.withColumn("ts", F.timestamp_millis("timestampMillis"))
    found = detect_stream(stream, "deviceId", "ts", "temperatureC", "1 minute")
    q = start_to_files(found.select("deviceId", "temperatureC", "timestampMillis"),
                       os.path.join(root, "out"), os.path.join(root, "ck"))
    q.awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(os.path.join(root, "out")).collect())
    batch = detect(readings.withColumn("ts", F.timestamp_millis("timestampMillis")),
                   "deviceId", "ts", "temperatureC", "1 minute")
    # The last window is still open in the stream; the first three are closed.
    expected = sorted(tuple(r) for r in batch.filter(F.col("timestampMillis") < 180000)
                      .select("deviceId", "temperatureC", "timestampMillis").collect())
    assert got == expected and len(expected) > 0


def test_window_stats_stream_matches_batch(spark):
    rows = sample_rows() + [("sensor-C", 1.0, 200000)]
    root = fresh_dir("sw-ws-")
    src = os.path.join(root, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.jsonl"), "w") as f:
        f.write(jsonl(rows))
    stream = read_jsonl_stream(spark, src)
    st = window_stats_stream(stream, "deviceId", "ts", "temperatureC", "1 minute")
    q = (st.writeStream.format("memory").queryName("ws_stream").outputMode("append")
         .option("checkpointLocation", os.path.join(root, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = {r.deviceId: (r.n, round(r.mean, 9)) for r in spark.sql("select * from ws_stream").collect()}
    assert got == {"sensor-A": (16, round(sum(x for d, x, _ in rows if d == "sensor-A") / 16, 9)),
                   "sensor-B": (15, round(sum(x for d, x, _ in rows if d == "sensor-B") / 15, 9))}
    batch = window_stats(spark.createDataFrame(rows, "deviceId string, temperatureC double, ms long")
                         .withColumn("ts", F.timestamp_millis("ms")), "deviceId", "ts", "temperatureC")
    assert batch.count() == 3                       # batch closes the last window too


def test_console_sink_prints_lines(spark, capsys):
    from conftest import readings_df
    found = detect(readings_df(spark, sample_rows()), "deviceId", "ts", "temperatureC")
    console_batch_writer()(found, 0)
    assert capsys.readouterr().out.strip() == SAMPLE_LINE


def test_batch_input_rejected(spark):
    from conftest import readings_df
    with pytest.raises(ValueError):
        detect_stream(readings_df(spark, sample_rows()), "deviceId", "ts", "temperatureC")


def test_stream_keeps_time_column_and_null_keys(spark):
    """Every input column (the event time included) can be selected from the stream's output,
    and a null key is a group like any other, as in batch."""
    import json

    root = fresh_dir("sw-nk-")
    src = os.path.join(root, "in")
    os.makedirs(src)
    rows = [{"site": None, "v": 20.0 + 0.1 * (i % 2), "ms": i} for i in range(20)]
    rows += [{"site": None, "v": 70.0, "ms": 50}, {"site": "x", "v": 1.0, "ms": 200_000}]
    with open(os.path.join(src, "a.json"), "w") as f:
        f.write("".join(json.dumps(r) + "\n" for r in rows))
    stream = (spark.readStream.schema("site string, v double, ms long").json(src)
              .withColumn("ts", F.timestamp_millis("ms")))
    found = detect_stream(stream, "site", "ts", "v")
    q = start_to_files(found, os.path.join(root, "out"), os.path.join(root, "ck"))
    q.awaitTermination()
    got = spark.read.parquet(os.path.join(root, "out")).collect()
    assert [(r.site, r.v, r.ms, r.n) for r in got] == [(None, 70.0, 50, 21)]
    assert got[0].ts is not None and got[0].window_start is not None


def test_salted_join_state_gives_the_same_answer(spark):
    """A hot device holding over a third of the readings: unsalted, salted and batch agree."""
    from datamaker import generate_readings

    cold = generate_readings(spark, 30, 20, 60000, 3, 0.5, 5)
    hot = generate_readings(spark, 1, 900, 60000, 3, 1.0, 6).withColumn(
        "deviceId", F.lit("device-hot"))
    readings = cold.unionByName(hot)
    root = fresh_dir("sw-salt-")
    src = os.path.join(root, "in")
    for w in range(3):
        readings.filter((F.col("timestampMillis") / 60000).cast("int") == w).coalesce(2) \
            .write.mode("append").json(src)
    results = []
    for salt in (1, 8):
        stream = (spark.readStream.schema(readings.schema).option("maxFilesPerTrigger", 2).json(src)
                  .withColumn("ts", F.timestamp_millis("timestampMillis")))
        found = detect_stream(stream, "deviceId", "ts", "temperatureC", salt_buckets=salt)
        out = os.path.join(root, f"out{salt}")
        q = start_to_files(found.select("deviceId", "temperatureC", "timestampMillis"), out,
                           os.path.join(root, f"ck{salt}"))
        q.awaitTermination()
        results.append(sorted(tuple(r) for r in spark.read.parquet(out).collect()))
    batch = detect(readings.withColumn("ts", F.timestamp_millis("timestampMillis")),
                   "deviceId", "ts", "temperatureC")
    expected = sorted(tuple(r) for r in batch.filter(F.col("timestampMillis") < 120000)
                      .select("deviceId", "temperatureC", "timestampMillis").collect())
    assert results[0] == results[1] == expected
    assert any(r[0] == "device-hot" for r in expected)


def test_watch_folder_prints_lines_as_windows_close(spark):
    """The streaming job: lines are printed once their window closes, once per checkpoint."""
    import io

    from sigmawatch.plans.jobs import watch_folder

    root = fresh_dir("sw-watch-")
    src, ckpt = os.path.join(root, "in"), os.path.join(root, "ck")
    os.makedirs(src)
    with open(os.path.join(src, "a.jsonl"), "w") as f:
        f.write(sample_text())
    out = io.StringIO()
    watch_folder(spark, src, ckpt, available_now=True, out=out).awaitTermination()
    assert out.getvalue() == ""                      # window still open
    with open(os.path.join(src, "b.jsonl"), "w") as f:
        f.write(jsonl([("sensor-C", 1.0, 121000)]))
    watch_folder(spark, src, ckpt, available_now=True, out=out).awaitTermination()
    assert out.getvalue().splitlines() == [SAMPLE_LINE]
