"""Batch detection: the reference's golden line, the edge cases, shapes agree, brute force."""

from __future__ import annotations

import math
import random

import pytest
from conftest import SAMPLE_LINE, readings_df, sample_rows
from pyspark.sql import functions as F

from sigmawatch.operators import detect, flag_counts, window_stats
from sigmawatch.plans.jobs import anomalies_of_readings
from sigmawatch.sinks.lines import LINE, with_lines

METHODS = ["incremental", "two_pass"]


def lines(df):
    return sorted(r[LINE] for r in with_lines(df).select(LINE).collect())


@pytest.mark.parametrize("method", METHODS)
def test_sample_file_golden_line(spark, method):
    found = anomalies_of_readings(readings_df(spark, sample_rows()), method=method)
    assert lines(found) == [SAMPLE_LINE]


@pytest.mark.parametrize("method", METHODS)
@pytest.mark.parametrize("rows", [
    [("d", 20.0, 1000)],                                   # single reading
    [("d", 0.0, 1000), ("d", 100.0, 2000)],                # two readings
    [("d", 0.3, 1000 + i) for i in range(100)],            # constant, avg != value in last digit
    [("d", 36.6, 1000 + i) for i in range(2000)],
])
def test_nothing_flagged(spark, method, rows):
    assert detect_rows(spark, rows, method) == []


def detect_rows(spark, rows, method="incremental", k=3.0, window="1 minute"):
    df = anomalies_of_readings(readings_df(spark, rows), window=window, k=k, method=method)
    return sorted((r.deviceId, r.temperatureC, r.timestampMillis)
                  for r in df.select("deviceId", "temperatureC", "timestampMillis").collect())


@pytest.mark.parametrize("method", METHODS)
def test_smallest_flagging_window(spark, method):
    rows = [("d", 20.0, 1000 + i) for i in range(10)] + [("d", 21.0, 2000)]
    assert detect_rows(spark, rows, method) == [("d", 21.0, 2000)]


@pytest.mark.parametrize("method", METHODS)
def test_window_edge_splits_groups(spark, method):
    # Twelve readings each side of 60000: the spike at 59999 is in [0, 60000) only.
    rows = [("d", 20.0 + 0.01 * (i % 3), 48000 + i) for i in range(11)] + [("d", 90.0, 59999)]
    rows += [("d", 90.0, 60000 + i) for i in range(12)]
    assert detect_rows(spark, rows, method) == [("d", 90.0, 59999)]


@pytest.mark.parametrize("method", METHODS)
def test_negative_outlier_and_duplicates(spark, method):
    rows = [("d", 20.0 + 0.1 * (i % 2), 1000 + i) for i in range(30)]
    rows += [("d", -40.0, 5000), ("d", -40.0, 5000)]   # same row twice: both count, both reported
    assert detect_rows(spark, rows, method) == [("d", -40.0, 5000)] * 2


def test_keys_are_separate(spark):
    rows = [("a", 20.0 + 0.1 * (i % 2), 1000 + i) for i in range(20)] + [("a", 80.0, 3000)]
    rows += [("b", 80.0 + 0.1 * (i % 2), 1000 + i) for i in range(20)]
    assert detect_rows(spark, rows) == [("a", 80.0, 3000)]


def test_k_is_a_parameter(spark):
    # z of the 3.0 reading is about 2.64: flagged at k = 2, not at k = 3.
    rows = [("d", float(v), 1000 + i) for i, v in enumerate([0] * 5 + [1] * 5 + [3])]
    assert detect_rows(spark, rows, k=3.0) == []
    assert detect_rows(spark, rows, k=2.0) == [("d", 3.0, 1010)]


def brute_force(rows, window_ms, k):
    groups = {}
    for r in rows:
        groups.setdefault((r[0], r[2] // window_ms), []).append(r)
    out = []
    for members in groups.values():
        xs = [m[1] for m in members]
        n = len(xs)
        if n < 2 or max(xs) == min(xs):
            continue
        mean = sum(xs) / n
        sd = math.sqrt(sum((x - mean) ** 2 for x in xs) / n)
        out += [m for m in members if abs(m[1] - mean) > k * sd]
    return sorted(out)


def test_shapes_agree_with_brute_force(spark):
    rnd = random.Random(7)
    rows = []
    for d in range(12):
        base = rnd.uniform(10, 30)
        for i in range(rnd.randint(1, 60)):
            x = base + rnd.gauss(0, 1)
            if rnd.random() < 0.05:
                x += rnd.choice([-1, 1]) * rnd.uniform(8, 15)
            rows.append((f"dev{d}", round(x, 3), rnd.randint(0, 179_999)))
    expected = brute_force(rows, 60_000, 3.0)
    assert expected, "fixture should contain outliers"
    for method in METHODS:
        assert detect_rows(spark, rows, method) == expected
    # Forced broadcast and forced shuffle joins give the same rows.
    df = readings_df(spark, rows)
    for how in ("broadcast", "shuffle"):
        got = detect(df, "deviceId", "ts", "temperatureC", "1 minute", 3.0, stats_join=how)
        assert sorted(tuple(r) for r in got.select("deviceId", "temperatureC",
                                                     "timestampMillis").collect()) == expected


def test_window_stats_values(spark):
    rows = [("d", float(x), 1000 * i) for i, x in enumerate([1, 2, 3, 4])]
    st = window_stats(readings_df(spark, rows), "deviceId", "ts", "temperatureC").first()
    assert st.n == 4 and st.mean == pytest.approx(2.5)
    assert st.stddev == pytest.approx(math.sqrt(1.25)) and st.m2 == pytest.approx(5.0)
    assert (st.lo, st.hi) == (1.0, 4.0)


def test_flag_counts_reports_every_window(spark):
    rows = [("d", 20.0 + 0.1 * (i % 2), i * 1000) for i in range(20)] + [("d", 90.0, 30_000)]
    rows += [("d", 5.0, 61_000)]
    got = flag_counts(readings_df(spark, rows), "deviceId", "ts", "temperatureC").orderBy(
        "window_start").collect()
    assert [(r.n, r.n_flagged) for r in got] == [(21, 1), (1, 0)]


def test_multiple_keys_and_null_key(spark):
    rows = [(None, "x", 20.0 + 0.1 * (i % 2), i) for i in range(20)] + [(None, "x", 70.0, 50)]
    df = spark.createDataFrame(rows, "site string, dev string, v double, ms long").withColumn(
        "ts", F.timestamp_millis("ms"))
    got = detect(df, ["site", "dev"], "ts", "v", "1 minute").collect()
    assert [(r.site, r.dev, r.v) for r in got] == [(None, "x", 70.0)]


def test_rejects_bad_arguments(spark):
    df = readings_df(spark, sample_rows())
    with pytest.raises(ValueError):
        detect(df, [], "ts", "temperatureC")
    with pytest.raises(ValueError):
        detect(df, "deviceId", "ts", "temperatureC", method="nope")
    with pytest.raises(ValueError):
        detect(df.withColumn("n", F.lit(1)), "deviceId", "ts", "temperatureC")


def test_group_filter_is_exact(spark):
    """``group_can_flag`` is true exactly for the groups where some reading is flagged."""
    from sigmawatch.functions.stats import group_can_flag, is_outlier
    from sigmawatch.operators.detect import group_stats
    from sigmawatch.operators.windows import assign_windows

    rnd = random.Random(11)
    rows = []
    for d in range(60):
        base, spread = rnd.uniform(-50, 50), rnd.choice([0.0, 0.01, 1.0, 100.0])
        for i in range(rnd.choice([1, 2, 5, 10, 11, 30])):
            x = base + rnd.gauss(0, spread) if spread else base
            if rnd.random() < 0.1:
                x += rnd.choice([-1, 1]) * spread * rnd.uniform(2, 6)
            rows.append((f"g{d}", round(x, 4), i))
    base = assign_windows(readings_df(spark, rows), "ts", "1 minute")
    group = ["deviceId", "window_start"]
    for k in (1.0, 2.0, 3.0):
        stats = group_stats(base, group, "temperatureC")
        predicted = {r.deviceId for r in stats.filter(group_can_flag(k)).collect()}
        joined = base.join(stats, group)
        actual = {r.deviceId for r in joined.filter(is_outlier("temperatureC", k)).collect()}
        assert predicted == actual
