"""Statistics store, bucketed archive, settings grid, compacted stream archive, lines and their numbers."""

from __future__ import annotations

import collections
import datetime as dt
import os
import random

import pytest
from conftest import fresh_dir
from pyspark.sql import functions as F

from sigmawatch.operators import detect, detect_grid, window_stats
from sigmawatch.plans.bucketed import BUCKET, SALT, archive_bucketed, bucketed_copy, detect_bucketed
from sigmawatch.plans.stats_store import StatsStore
from sigmawatch.plans.stream_archive import StreamArchive
from sigmawatch.sinks.lines import LINE, line_batch_writer, print_lines, read_lines
from sigmawatch.sources import malformed_lines, read_jsonl

SCHEMA = "device string, ts timestamp_ntz, v double, note string"
START = dt.datetime(2024, 1, 1)


def rows(n=1500, hot=True, days=20):
    """Readings with null devices and values, equal rows and spikes; ``hot``: one device has a third."""
    rnd, out = random.Random(5), []
    for i in range(n):
        device = None if i % 60 == 9 else ("hot" if hot and i % 3 == 0 else f"d{i % 5}")
        value = None if i % 45 == 2 else (70.0 if i % 90 == 31 else round(rnd.gauss(20, 1), 3))
        out.append((device, START + dt.timedelta(minutes=rnd.randrange(days * 1440)), value, f"r{i}"))
    return out + out[:5]


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)


def notes(df):
    return sorted((r.note, r.window_start, r.n) for r in df.collect())


def same_stats(got, expected):
    """Equal statistics, floating-point figures to nine digits."""
    cols = ["device", "window_start", "window_end", "n", "lo", "hi", "mean", "stddev", "m2"]
    both = [sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda r: repr(r[:6])) for df in (got, expected)]
    assert len(both[0]) == len(both[1]) > 0
    for a, b in zip(*both, strict=True):
        assert a[:6] == b[:6] and [v is None for v in a] == [v is None for v in b]
        figures = [[v or 0.0 for v in r[6:]] for r in (a, b)]
        assert figures[0] == pytest.approx(figures[1], rel=1e-9, abs=1e-9), (a, b)


# ---- statistics store -------------------------------------------------------------------------

def test_a_repeated_batch_changes_nothing(spark):
    store = StatsStore(spark, os.path.join(fresh_dir(), "s"), "device", "ts", "v", "6 hours")
    data = rows()
    for batch_id, part in ((0, data[:400]), (1, data[400:1100]), (0, data[:400]), (2, data[1100:]), (1, data[400:1100])):
        store.append(frame(spark, part), batch_id)
    same_stats(store.read(), window_stats(frame(spark, data), "device", "ts", "v", "6 hours"))


def test_a_store_fed_by_a_stream(spark):
    root = fresh_dir()
    store = StatsStore(spark, os.path.join(root, "s"), "device", "ts", "v", "1 day")
    data = rows()
    for part in (data[:700], data[700:]):
        frame(spark, part).write.mode("append").parquet(os.path.join(root, "in"))
        stream = spark.readStream.schema(SCHEMA).parquet(os.path.join(root, "in"))
        store.append_stream(stream, os.path.join(root, "ckpt")).awaitTermination()
    same_stats(store.read(), window_stats(frame(spark, data), "device", "ts", "v", "1 day"))


def test_parts_merge_far_from_zero(spark):
    far = [("a", START, 1e9 + x, "n") for x in (0.0, 0.1, 0.2, 0.3)]
    store = StatsStore(spark, os.path.join(fresh_dir(), "s"), "device", "ts", "v", "1 day")
    for i, r in enumerate(far):
        store.append(frame(spark, [r]), i)
    assert store.read().first().stddev == pytest.approx(0.1118033988, rel=1e-5)


# ---- bucketed archive -------------------------------------------------------------------------

@pytest.mark.parametrize("join", ["shuffle_hash", "shuffle_merge", "broadcast", "auto"])
def test_bucketed_detection_equals_detect(spark, join):
    archived = bucketed_copy(spark, frame(spark), "device", 8, salts=4)
    found = detect_bucketed(archived, "device", "ts", "v", "1 day", 2.5, salts=4, stats_join=join)
    expected = detect(frame(spark), "device", "ts", "v", "1 day", 2.5)
    assert notes(found) == notes(expected) and expected.count() > 5
    assert found.columns == expected.columns


@pytest.mark.parametrize("join", ["shuffle_hash", "shuffle_merge"])
def test_bucketed_readings_cross_no_exchange(spark, join):
    archived = bucketed_copy(spark, frame(spark), "device", 8, salts=4)
    found = detect_bucketed(archived, "device", "ts", "v", "1 day", 2.5, salts=4, stats_join=join)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("== Initial Plan ==")[0].splitlines()
    at = next(i for i, x in enumerate(lines) if "FileScan" in x and "note" in x)
    depth = len(lines[at]) - len(lines[at].lstrip(" :+-*()0123456789"))
    above = []
    for x in reversed(lines[:at]):
        d = len(x) - len(x.lstrip(" :+-*()0123456789"))
        if d < depth:
            above.append(x)
            depth = d
    assert any("Join" in x for x in above)
    assert not any("Exchange" in x or "AQEShuffleRead" in x for x in above), plan
    assert "SelectedBucketsCount: 8 out of 8" in plan


def test_a_hot_key_is_spread_over_buckets(spark):
    data = [("hot" if i % 3 else f"d{i % 50}", START + dt.timedelta(seconds=i), float(i), f"{i}") for i in range(6000)]
    archived = bucketed_copy(spark, frame(spark, data), "device", 8, salts=64)
    per_bucket = (archived.groupBy(F.pmod(F.hash(BUCKET), F.lit(8)).alias("b"))
                  .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("device") == "hot").alias("hot")).collect())
    assert max(r.hot for r in per_bucket) < 4000 / 3 and max(r.n for r in per_bucket) < 6000 / 3


def test_bucketed_tables_stay_in_the_catalog_if_asked(spark):
    name = "readings_by_device"
    archive_bucketed(frame(spark), name, "device", 4, path=os.path.join(fresh_dir(), "t"))
    try:
        assert {SALT, BUCKET} < set(spark.table(name).columns)
        assert notes(detect_bucketed(spark.table(name), "device", "ts", "v", "7 days")) == notes(
            detect(frame(spark), "device", "ts", "v", "7 days"))
    finally:
        spark.sql(f"DROP TABLE {name}")
    with pytest.raises(ValueError, match="not a bucketed archive"):
        detect_bucketed(frame(spark), "device", "ts", "v")


# ---- grid -------------------------------------------------------------------------------------

def test_grid_equals_single_settings(spark):
    windows, sigmas = ("4 hours", "1 day", "3 days"), (1.5, 2.0, 3.0)
    grid = detect_grid(frame(spark), "device", "ts", "v", windows, sigmas)
    got = collections.defaultdict(list)
    for r in grid.collect():
        got[r.window, r.k].append((r.note, r.window_start, r.n))
    for w in windows:
        for k in sigmas:
            assert sorted(got[w, k]) == notes(detect(frame(spark), "device", "ts", "v", w, k)), (w, k)


def test_grid_reads_the_input_twice(spark):
    path = os.path.join(fresh_dir(), "in")
    frame(spark).write.parquet(path)
    counter = spark.sparkContext.accumulator(0)
    seen = spark.read.parquet(path)
    touch = F.udf(lambda v: (counter.add(1), v)[1], "double").asNondeterministic()
    n = seen.count()
    found = detect_grid(seen.withColumn("v", touch("v")), "device", "ts", "v", ("4 hours", "1 day", "3 days"),
                        (1.5, 2.0, 3.0))
    found.collect()
    assert counter.value == 2 * n
    with pytest.raises(ValueError):
        detect_grid(seen, "device", "ts", "v", (), (3.0,))


# ---- compacted archive ------------------------------------------------------------------------

def files_below(path):
    return sum(f.endswith(".parquet") for _, _, names in os.walk(path) for f in names)


def test_many_batches_of_thirty_dates_become_files_that_follow_the_data(spark):
    path = os.path.join(fresh_dir(), "a")
    archive = StreamArchive(spark, path, spark.createDataFrame([], SCHEMA).schema)
    written, batches, dates = [], 40, 30
    readers = []
    for b in range(batches):
        part = [(f"d{b}", START + dt.timedelta(days=d, seconds=b), 1.0, f"{b}-{d}") for d in range(dates)]
        archive.append(frame(spark, part).coalesce(1), b)
        written += [r[3] for r in part]
        if b == batches // 2:
            archive.append(frame(spark, part).coalesce(1), b)  # a batch that is run again
            readers.append((archive.read(), sorted(written)))
            assert archive.compact() == 1
    readers.append((archive.read(), sorted(written)))
    assert archive.compact() == 2 and archive.compact() == 2
    archive.append(frame(spark, part).coalesce(1), batches - 1)  # merged already
    readers.append((archive.read(), sorted(written)))
    for reader, expected in readers:                           # also those that began before
        assert sorted(r.note for r in reader.collect()) == expected
    assert files_below(os.path.join(path, "merged", "gen=2")) <= 2 * dates
    archive.vacuum()
    assert sorted(r.note for r in archive.read().collect()) == sorted(written)
    assert files_below(path) <= 2 * dates
    one = archive.read().filter(F.col("date") == dt.date(2024, 1, 3))
    assert one.count() == batches


def test_only_touched_dates_are_rewritten_and_failures_leave_no_trace(spark):
    path = os.path.join(fresh_dir(), "a")
    archive = StreamArchive(spark, path, spark.createDataFrame([], SCHEMA).schema)
    assert archive.read().count() == 0 and archive.compact() == 0
    archive.append(frame(spark, [("a", START + dt.timedelta(days=d), 1.0, f"a{d}") for d in range(5)]), 0)
    archive.compact()
    archive.append(frame(spark, [("a", START + dt.timedelta(days=3, hours=1), 1.0, "b3")]), 1)
    # Files without a mark, as a failed compaction leaves them.
    frame(spark, [("x", START, 1.0, "lost")]).withColumn("date", F.lit(dt.date(2024, 1, 1))).write.partitionBy(
        "date").parquet(os.path.join(path, "merged", "gen=2"))
    assert sorted(r.note for r in archive.read().collect()) == ["a0", "a1", "a2", "a3", "a4", "b3"]
    assert archive.compact() == 2
    assert sorted(os.listdir(os.path.join(path, "merged", "gen=2"))) == ["._SUCCESS.crc", "_SUCCESS", "date=2024-01-04"]
    assert sorted(r.note for r in archive.read().collect()) == ["a0", "a1", "a2", "a3", "a4", "b3"]
    assert sorted(r.note for r in archive.read(version=1).filter("date < '2024-01-04'").collect()) == ["a0", "a1", "a2"]


# ---- lines ------------------------------------------------------------------------------------

def test_printing_is_bounded(spark, capsys):
    found = spark.createDataFrame([("d", 1.0, i) for i in range(20)], "deviceId string, temperatureC double, timestampMillis long")
    with pytest.raises(ValueError, match="more than 19"):
        print_lines(found, limit=19)
    assert capsys.readouterr().out == ""
    assert print_lines(found, limit=20) == 20


def test_a_repeated_batch_writes_each_line_once(spark):
    path = os.path.join(fresh_dir(), "lines")
    write = line_batch_writer(path)
    batch = [spark.createDataFrame([("d", 1.0, i) for i in part], "deviceId string, temperatureC double, timestampMillis long")
             for part in (range(5), range(5, 9))]
    write(batch[0], 0)
    write(batch[1], 1)
    write(batch[0], 0)
    got = sorted(r[LINE] for r in read_lines(spark, path).collect())
    assert got == [f"Device d, measurement 1.0 C, time {i}" for i in range(9)]


def text_file(text, folder=None):
    path = os.path.join(folder or fresh_dir(), "r.jsonl")
    with open(path, "w", newline="") as f:
        f.write(text)
    return path


@pytest.mark.parametrize("text, expected", [
    ('{"deviceId": "x", "temperatureC": "20.5", "timestampMillis": 5}', ("x", 20.5, 5)),
    ('{"deviceId": "x", "temperatureC": 20, "timestampMillis": 60000.0}', ("x", 20.0, 60000)),
    ('{"deviceId": "x", "temperatureC": " -2e1 ", "timestampMillis": "7"}', ("x", -20.0, 7)),
    ('{"deviceId": 5, "temperatureC": 1, "timestampMillis": 1.9e3}', ("5", 1.0, 1900)),
    ('{"deviceId": "x", "temperatureC": 1, "timestampMillis": 9007199254740993}', ("x", 1.0, 9007199254740993)),
    ('{"deviceId": "x", "temperatureC": "warm", "timestampMillis": 5}', None),
    ('{"deviceId": "x", "temperatureC": "NaN", "timestampMillis": 5}', None),
    ('{"deviceId": "x", "temperatureC": true, "timestampMillis": 5}', None),
    ('{"deviceId": "x", "temperatureC": 1, "timestampMillis": "5.0"}', None),
    ('{"deviceId": "x", "temperatureC": 1, "timestampMillis": ""}', None),
    ('{"deviceId": "x", "temperatureC": {"a": 1}, "timestampMillis": 5}', None),
    ('[1, 2]', None),
])
def test_numbers_as_text_and_times_with_a_fraction(spark, text, expected):
    path = text_file("# head\n" + text + "\n")
    got = [tuple(r) for r in read_jsonl(spark, path, strict=False).drop("ts").collect()]
    assert got == ([expected] if expected else [])
    if expected is None:
        with pytest.raises(Exception, match="Malformed reading on line 2"):
            read_jsonl(spark, path, numbered=True).count()


def test_line_numbers_in_files_of_several_splits(spark):
    good = '{"deviceId": "d", "temperatureC": 1.5, "timestampMillis": %d}'
    lines = [("# comment" if i % 10 == 3 else "" if i % 10 == 7 else good % i) for i in range(4000)]
    for i in (1, 1777, 3999):
        lines[i] = f"bad {i}"
    folder = fresh_dir()
    for name, sep in (("a", "\n"), ("b", "\r\n")):
        os.makedirs(os.path.join(folder, name))
        text_file(sep.join(lines) + sep, os.path.join(folder, name))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        spark.conf.set("spark.sql.files.openCostInBytes", "1000")
        found = malformed_lines(spark, os.path.join(folder, "*"))
        assert found.rdd.getNumPartitions() > 1
        got = sorted((r.file.split("/")[-2], r.line_no, r.line) for r in found.collect())
        with pytest.raises(Exception, match=r"Malformed reading on line \d+ in .*: bad"):
            read_jsonl(spark, os.path.join(folder, "*"), numbered=True).count()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == [(n, i + 1, f"bad {i}") for n in "ab" for i in (1, 1777, 3999)]
