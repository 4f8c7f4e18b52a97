"""A stream's life: late rows over many batches, a stop in mid-input, open windows, the end, timers."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from conftest import fresh_dir
from pyspark.sql import functions as F

from sigmawatch.operators import detect, window_stats
from sigmawatch.plans.stream_queries import arrive_in_pieces, stop_after
from sigmawatch.streaming import (
    counting_late_rows, detect_stream, detect_with_timers, open_windows, rows_dropped_by_watermark,
    run_to_end, start_to_files, window_stats_stream,
)

SCHEMA = "device string, ts timestamp_ntz, v double, note string"
START = dt.datetime(2024, 1, 1)


def rows(n=600, devices=3, seconds=7, hot=False):
    """Readings over several ten-minute windows, a spike in each hundred, null devices and values; with
    ``hot`` one device holds two thirds."""
    out = []
    for i in range(n):
        device = None if i % 50 == 7 else f"d{0 if hot and i % 3 else i % devices}"
        value = None if i % 40 == 3 else (99.0 if i % 100 == 42 else 20.0 + (i * 7 % 11) / 10)
        out.append((device, START + dt.timedelta(seconds=seconds * i, microseconds=i), value, f"r{i}"))
    return out


def folders(*names):
    root = fresh_dir("sw-life-")
    return [os.path.join(root, n) for n in names]


def stream_of(spark, path, files=None):
    reader = spark.readStream.schema(SCHEMA)
    return (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(path)


def notes(df, last=None):
    return sorted(r.note for r in (df.filter(last) if last is not None else df).collect())


def found_by(spark, path):
    return notes(spark.read.parquet(path))


def batch(spark, data):
    return detect(spark.createDataFrame(data, SCHEMA), "device", "ts", "v", "10 minutes", 3.0)


def closed_by(data, delay=1):
    return F.col("window_end") <= F.lit(max(r[1] for r in data) - dt.timedelta(seconds=delay))


# ---- late rows --------------------------------------------------------------------------------

def test_late_rows_are_counted_over_more_than_a_hundred_batches(spark):
    src, out, ckpt = folders("in", "out", "ckpt")
    os.makedirs(src)
    batches, late = 110, 0
    # Each file moves the watermark by a window; all but the first bring one reading of a window that
    # the batch before has closed.
    for i in range(batches):
        now = START + dt.timedelta(minutes=10 * i)
        lines = [f"a,{now.isoformat()},1.0,{i}"]
        if i > 3:
            late += 1
            lines.append(f"a,{(now - dt.timedelta(minutes=40)).isoformat()},5.0,late {i}")
        with open(os.path.join(src, f"{i:04d}.csv"), "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(os.path.join(src, f"{i:04d}.csv"), (1_700_000_000 + i, 1_700_000_000 + i))
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        readings = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).csv(src)
        stream = window_stats_stream(readings, "device", "ts", "v", "10 minutes")
        with counting_late_rows(spark) as counter:
            query = start_to_files(stream, out, ckpt)
            query.awaitTermination()
            assert counter.total(query) == late
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    assert rows_dropped_by_watermark(query) < late     # progress of a hundred batches at most
    assert spark.read.parquet(out).agg(F.sum("n")).first()[0] <= batches


# ---- restart ----------------------------------------------------------------------------------

def test_a_run_stopped_in_mid_input_is_taken_up_by_the_next(spark):
    src, out, ckpt = folders("in", "out", "ckpt")
    data = rows()
    files = arrive_in_pieces(spark.createDataFrame(data, SCHEMA), src, pieces=8)

    def start(**how):
        found = detect_stream(stream_of(spark, src, files), "device", "ts", "v", "10 minutes", 3.0)
        return start_to_files(found, out, ckpt, **how)

    stop_after(start(available_now=False, processing_time="0 seconds"), 2)
    done = [f for f in os.listdir(os.path.join(ckpt, "commits")) if f.isdigit()]
    assert 2 <= len(done) < 8                          # in the middle of its input
    start().awaitTermination()
    expected = notes(batch(spark, data), closed_by(data))
    assert found_by(spark, out) == expected and expected
    start().awaitTermination()
    assert found_by(spark, out) == expected


# ---- open windows -----------------------------------------------------------------------------

def test_open_windows_are_read_from_the_state(spark):
    src, out, ckpt = folders("in", "out", "ckpt")
    data = rows(500)
    spark.createDataFrame(data, SCHEMA).write.parquet(src)
    stats = window_stats_stream(stream_of(spark, src), "device", "ts", "v", "10 minutes")
    start_to_files(stats, out, ckpt).awaitTermination()
    still = open_windows(spark, ckpt, "device", ntz=True)
    whole = window_stats(spark.createDataFrame(data, SCHEMA), "device", "ts", "v", "10 minutes")
    assert sorted(still.columns) == sorted(whole.columns)

    def plain(df):
        return sorted(((r.device, r.window_start, r.window_end, r.n, round(r.mean, 9), round(r.stddev, 9),
                        round(r.m2, 6), r.lo, r.hi) for r in df.collect()), key=repr)

    assert plain(still) == plain(whole.filter(~closed_by(data))) and still.count() > 0
    with pytest.raises(ValueError, match="no key"):
        open_windows(spark, ckpt, "other")


# ---- the end of a bounded stream --------------------------------------------------------------

@pytest.mark.parametrize("method", [detect_stream, detect_with_timers])
def test_a_bounded_stream_closes_its_last_windows(spark, method):
    src, out, ckpt, clock = folders("in", "out", "ckpt", "clock")
    data = rows(500)
    spark.createDataFrame(data, SCHEMA).write.parquet(src)
    run_to_end(stream_of(spark, src), lambda s: method(s, "device", "ts", "v", "10 minutes", 3.0),
               out, ckpt, clock, "ts", "10 minutes")
    expected = notes(batch(spark, data))
    assert found_by(spark, out) == expected
    assert len(notes(batch(spark, data), closed_by(data))) < len(expected)


def test_an_empty_bounded_stream_ends_without_rows(spark):
    src, out, ckpt, clock = folders("in", "out", "ckpt", "clock")
    spark.createDataFrame([], SCHEMA).write.parquet(src)
    run_to_end(stream_of(spark, src), lambda s: detect_stream(s, "device", "ts", "v"), out, ckpt, clock, "ts",
               "1 minute")
    assert not os.path.exists(out) or spark.read.schema(SCHEMA).parquet(out).count() == 0


# ---- stateful function ------------------------------------------------------------------------

@pytest.mark.parametrize("hot", [False, True])
def test_timers_give_what_the_join_gives(spark, hot):
    data = rows(900, hot=hot)
    src, = folders("in")
    files = arrive_in_pieces(spark.createDataFrame(data, SCHEMA), src, pieces=4)
    results = []
    for method in (detect_stream, detect_with_timers):
        out, ckpt = folders("out", "ckpt")
        found = method(stream_of(spark, src, files), "device", "ts", "v", "10 minutes", 3.0)
        start_to_files(found, out, ckpt).awaitTermination()
        back = spark.read.parquet(out)
        results.append(sorted(((r.device, r.ts, r.v, r.note, r.window_start, r.window_end, r.n, round(r.mean, 9),
                                round(r.stddev, 9)) for r in back.collect()), key=repr))
    assert results[0] == results[1] and results[0]
    assert sorted(r[3] for r in results[0]) == notes(batch(spark, data), closed_by(data))


def test_timers_drop_late_readings_and_refuse_batches(spark):
    src, out, ckpt = folders("in", "out", "ckpt")
    first = [("a", START + dt.timedelta(seconds=i), 20.0 + i % 2, f"{i}") for i in range(60)]
    for data in (first, [("a", START + dt.timedelta(minutes=30), 1.0, "later")],
                 [("a", START + dt.timedelta(seconds=5), 999.0, "late")]):
        spark.createDataFrame(data, SCHEMA).write.mode("append").parquet(src)
        found = detect_with_timers(stream_of(spark, src), "device", "ts", "v", "10 minutes", 3.0)
        start_to_files(found, out, ckpt).awaitTermination()
    assert found_by(spark, out) == []
    with pytest.raises(ValueError):
        detect_with_timers(spark.createDataFrame(first, SCHEMA), "device", "ts", "v")
