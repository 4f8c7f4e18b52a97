"""Statistics merge (Chan) and the archive/replay plan."""

from __future__ import annotations

import math
import os
import random

import pytest
from conftest import SF_SMALL, fresh_dir, readings_df
from pyspark.sql import functions as F

from sigmawatch.operators import detect, merge_stats, window_stats
from sigmawatch.plans.archive import archive_readings, duration_millis, replay


def test_merge_equals_direct_stats(spark):
    rnd = random.Random(3)
    rows = [(f"d{rnd.randint(0, 4)}", rnd.gauss(20, 3), rnd.randint(0, 3_599_999)) for _ in range(3000)]
    df = readings_df(spark, rows)
    fine = window_stats(df, "deviceId", "ts", "temperatureC", "1 minute")
    merged = {r.deviceId: r for r in merge_stats(fine, "deviceId", "1 hour").collect()}
    direct = {r.deviceId: r for r in window_stats(df, "deviceId", "ts", "temperatureC", "1 hour").collect()}
    assert merged.keys() == direct.keys()
    for key, m in merged.items():
        d = direct[key]
        assert (m.n, m.lo, m.hi, m.window_start, m.window_end) == (d.n, d.lo, d.hi, d.window_start, d.window_end)
        assert m.mean == pytest.approx(d.mean, rel=1e-12)
        assert m.stddev == pytest.approx(d.stddev, rel=1e-10)
        assert m.m2 == pytest.approx(d.m2, rel=1e-10)


def test_merge_is_stable_far_from_zero(spark):
    # Large offset, small spread: the naive sum-of-squares formula loses every digit here.
    rows = [("d", 1e9 + (i % 7) * 1e-3, i * 1000) for i in range(600)]
    fine = window_stats(readings_df(spark, rows), "deviceId", "ts", "temperatureC", "1 minute")
    m = merge_stats(fine, "deviceId", "10 minutes").first()
    xs = [r[1] for r in rows]
    mu = sum(xs) / len(xs)
    expected = math.sqrt(sum((x - mu) ** 2 for x in xs) / len(xs))
    assert m.stddev == pytest.approx(expected, rel=1e-4)


def test_duration_millis():
    assert duration_millis("1 minute") == 60_000
    assert duration_millis("7 days") == 7 * 86_400_000
    assert duration_millis("1 hour 30 minutes") == 5_400_000
    with pytest.raises(ValueError):
        duration_millis("1 month")


def test_replay_equals_detect_on_range_and_prunes(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_id", "ts", "event_type", "value")
    path = os.path.join(fresh_dir("sw-arch-"), "archive")
    archive_readings(ev, path)
    assert any(d.startswith("date=") for d in os.listdir(path))
    got = replay(spark, path, "2024-01-08", "2024-01-21", "event_type", "ts", "value", "7 days", 2.0)
    # Whole 7-day windows overlapping the range, computed from all of their readings.
    full = detect(ev, "event_type", "ts", "value", "7 days", 2.0)
    lo = F.lit("2024-01-08 00:00:00").cast("timestamp_ntz")
    hi = F.lit("2024-01-22 00:00:00").cast("timestamp_ntz")
    expected = full.filter((F.col("window_end") > lo) & (F.col("window_start") < hi))
    key = ["event_id", "window_start"]
    assert sorted(got.select(*key).collect()) == sorted(expected.select(*key).collect())
    assert expected.count() > 0
    plan = spark.read.parquet(path).filter(F.col("date") >= F.lit("2024-01-04").cast("date"))
    assert "PartitionFilters" in plan._jdf.queryExecution().executedPlan().toString()


def test_stream_archive_then_replay(spark):
    """Readings arriving as a stream are archived by date (exactly once across restarts), and a
    replay over the archive equals batch detection over the same readings."""
    from conftest import jsonl

    from sigmawatch.plans.archive import archive_stream
    from datamaker import generate_readings
    from sigmawatch.sources import read_jsonl_stream

    readings = generate_readings(spark, 30, 40, 86_400_000, 3, 0.5, 21)
    rows = [tuple(r) for r in readings.collect()]
    root = fresh_dir("sw-sarch-")
    src, path, ckpt = (os.path.join(root, p) for p in ("in", "archive", "ck"))
    os.makedirs(src)
    for day in range(3):
        with open(os.path.join(src, f"d{day}.jsonl"), "w") as f:
            f.write(jsonl([r for r in rows if r[2] // 86_400_000 == day]))
        q = archive_stream(read_jsonl_stream(spark, src), path, ckpt, available_now=True)
        q.awaitTermination()
    assert sorted(d for d in os.listdir(path) if d.startswith("date=")) == [
        "date=1970-01-01", "date=1970-01-02", "date=1970-01-03"]
    assert spark.read.parquet(path).count() == len(rows)        # each file archived once
    got = replay(spark, path, "1970-01-02", "1970-01-03", "deviceId", "ts", "temperatureC", "1 day")
    batch = detect(readings.withColumn("ts", F.timestamp_millis("timestampMillis")),
                   "deviceId", "ts", "temperatureC", "1 day")
    expected = batch.filter(F.col("timestampMillis") >= 86_400_000)
    key = ["deviceId", "timestampMillis"]
    assert sorted(got.select(*key).collect()) == sorted(expected.select(*key).collect())
    assert expected.count() > 0
