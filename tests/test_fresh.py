"""Statistics follow the input of each call; nothing stays cached; merge and size guards."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sigmawatch.operators import detect, flag_counts, merge_stats, window_stats
from sigmawatch.operators.attach import measure
from sigmawatch.sources import read_jsonl, write_jsonl

from conftest import fresh_dir, sample_rows
from sigmawatch.sources import READING_SCHEMA


def rows_frame(spark, rows):
    return spark.createDataFrame(rows, READING_SCHEMA)


@pytest.mark.parametrize("method", ["incremental", "two_pass"])
def test_changed_input_gets_new_statistics(spark, method):
    path = fresh_dir() + "/readings"
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    write_jsonl(rows_frame(spark, sample_rows()), path)

    def flagged():
        return detect(read_jsonl(spark, path), "deviceId", "ts", "temperatureC", "1 minute", 3.0, method).count()

    def counted():
        got = flag_counts(read_jsonl(spark, path), "deviceId", "ts", "temperatureC", "1 minute", 3.0, method)
        return {r.deviceId: (r.n, r.n_flagged) for r in got.collect()}

    assert flagged() == 1 and counted() == {"sensor-A": (16, 1), "sensor-B": (15, 0)}
    more = [("sensor-A", 95.4, 60000 + 10 * i) for i in range(20)]
    rows_frame(spark, more).selectExpr("to_json(struct(*)) AS value").coalesce(1).write.mode("append").text(path)
    assert flagged() == 0 and counted() == {"sensor-A": (36, 0), "sensor-B": (15, 0)}
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == before


def test_merge_refuses_windows_that_do_not_add_up(spark):
    r = rows_frame(spark, sample_rows()).withColumn("ts", F.timestamp_millis("timestampMillis"))
    fine = window_stats(r, "deviceId", "ts", "temperatureC", "1 hour")
    with pytest.raises(ValueError, match="do not add up"):
        merge_stats(fine, "deviceId", "90 minutes")
    assert merge_stats(fine, "deviceId", "2 hours").count() == 2
    assert merge_stats(fine.limit(0), "deviceId", "90 minutes").count() == 0


@pytest.mark.parametrize(("key", "least"), [("cast(repeat('x', 1000) as binary)", 2000),
                                            ("array(repeat('x', 1000))", 1 << 40),
                                            ("struct(1)", 1 << 40)])
def test_measured_size_covers_every_type(spark, key, least):
    size = measure(spark.range(2).select(F.expr(key).alias("k"), "id"))
    assert size.rows == 2 and size.est_bytes >= least
    assert size.broadcast == (least < 1 << 40)


def test_decimal_values_are_averaged_as_doubles(spark):
    rows = [("a", Decimal(v), 60000 + i) for i, v in enumerate([1, 1, 2] * 7 + [500])]
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.DecimalType(38, 0)),
                           T.StructField("ms", T.LongType())])
    df = spark.createDataFrame(rows, schema).withColumn("ts", F.timestamp_millis("ms"))
    for method in ("incremental", "two_pass"):
        got = detect(df, "k", "ts", "v", "1 minute", 3.0, method).collect()
        assert len(got) == 1 and got[0]["mean"] == pytest.approx(528 / 22)


def test_archive_files_follow_the_data(spark):
    import os

    from sigmawatch.plans import archive_readings
    path = fresh_dir() + "/archive"
    many = spark.range(0, 30_000, 1, 32).select(
        "id", F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(30)) * 86_400).alias("ts"))
    archive_readings(many, path)
    files = [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    assert 30 <= len(files) < 200
    assert spark.read.parquet(path).count() == 30_000
