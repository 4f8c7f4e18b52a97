"""Plan shape: size-checked broadcast, shuffle fallback, pruning, no per-group buffers."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL, readings_df, sample_rows

from sigmawatch.operators import detect
from sigmawatch.operators.attach import measure


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_stats_are_broadcast(spark):
    found = detect(readings_df(spark, sample_rows()), "deviceId", "ts", "temperatureC")
    plan = plan_of(found)
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    assert "Window" not in plan and "collect_list" not in plan


def test_threshold_off_means_shuffle_join(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = detect(readings_df(spark, sample_rows()), "deviceId", "ts", "temperatureC")
        plan = plan_of(found)
        assert "BroadcastExchange" not in plan
        assert found.count() == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_join_strategy_rule():
    from sigmawatch.operators.attach import StatsSize
    assert StatsSize(10, 1_000, 10_000, 8).strategy == "broadcast"
    assert StatsSize(10, 50_000, 10_000, 8).strategy == "shuffle_hash"     # 6.25 KB a partition
    assert StatsSize(10, 500_000, 10_000, 8).strategy == "shuffle_merge"
    assert StatsSize(10, 1_000, -1, 8).strategy == "shuffle_merge"         # broadcast disabled


@pytest.mark.parametrize("how", ["shuffle_hash", "shuffle_merge"])
def test_forced_shuffle_joins_are_not_broadcast(spark, how):
    found = detect(readings_df(spark, sample_rows()), "deviceId", "ts", "temperatureC", stats_join=how)
    assert found.count() == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan
    assert ("ShuffledHashJoin" if how == "shuffle_hash" else "SortMergeJoin") in plan


def test_measure_counts_string_bytes(spark):
    df = spark.createDataFrame([("abcd", 1), ("ef", 2)], "k string, v long")
    size = measure(df)
    assert size.rows == 2 and size.est_bytes == 2 * (32 + 16) + 6


def test_scan_is_pruned(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    found = detect(ev.select("event_id", "ts", "event_type", "value"), "event_type", "ts", "value", "7 days")
    plan = plan_of(found)
    assert "props" not in plan and "user_id" not in plan


def test_hot_group_is_split_by_adaptive_skew_join(spark):
    """One (key, window) holds well over a third of all readings; on the shuffle path adaptive
    execution splits its partition into several tasks, and the answer is unchanged."""
    from pyspark.sql import functions as F
    from test_detect import brute_force

    from sigmawatch.sources.readings import with_event_time

    hot = spark.range(0, 60_000).select(
        F.lit("hot").alias("deviceId"),
        (F.lit(20.0) + (F.col("id") % 7) * 0.1 + F.when(F.col("id") == 777, 50.0).otherwise(0.0))
        .alias("temperatureC"),
        (F.col("id") % 60_000).alias("timestampMillis"))
    cold = spark.range(0, 40_000).select(
        F.concat(F.lit("c"), (F.col("id") % 400).cast("string")).alias("deviceId"),
        (F.lit(10.0) + (F.col("id") % 5) * 0.2).alias("temperatureC"),
        (F.col("id") % 60_000).alias("timestampMillis"))
    readings = with_event_time(hot.unionByName(cold)).repartition(16)
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        found = detect(readings, "deviceId", "ts", "temperatureC", "1 minute", stats_join="shuffle")
        picked = found.select("deviceId", "temperatureC", "timestampMillis")
        rows = sorted(tuple(r) for r in picked.collect())
        plan = picked._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert "skew=true" in plan
    local = [tuple(r) for r in readings.select("deviceId", "temperatureC", "timestampMillis").collect()]
    assert rows == brute_force(local, 60_000, 3.0) and len(rows) >= 1


def test_auto_picks_shuffled_hash_join_beyond_the_threshold(spark):
    """Statistics over the broadcast threshold, but small per shuffle partition: auto picks a
    shuffled hash join; the answer equals brute force."""
    from test_detect import brute_force

    rows = [(f"d{d}", 20.0 + 0.1 * (i % 3) + (30.0 if i == 7 else 0.0), 1000 * i)
            for d in range(200) for i in range(12)]
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                          "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "2KB")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        found = detect(readings_df(spark, rows), "deviceId", "ts", "temperatureC")
        picked = found.select("deviceId", "temperatureC", "timestampMillis")
        got = sorted(tuple(r) for r in picked.collect())
        plan = picked._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert "ShuffledHashJoin" in plan and "BroadcastHashJoin" not in plan
    assert got == brute_force(rows, 60_000, 3.0) and len(got) == 200


def test_checkpoint_folder_rule():
    """A configured folder is used as is; a local master without one gets a temporary folder;
    a cluster without one is an error (no machine-local folder for shared intermediates)."""
    from types import SimpleNamespace

    from sigmawatch.session import ensure_checkpoint_dir

    def fake(master, configured=None, current=None):
        state = {"dir": current}
        sc = SimpleNamespace(
            master=master,
            getCheckpointDir=lambda: state["dir"],
            getConf=lambda: SimpleNamespace(get=lambda key, default=None: configured),
            setCheckpointDir=lambda d: state.__setitem__("dir", d))
        return SimpleNamespace(sparkContext=sc)

    assert ensure_checkpoint_dir(fake("yarn", current="hdfs:///ck")) == "hdfs:///ck"
    assert ensure_checkpoint_dir(fake("yarn", configured="hdfs:///shared")) == "hdfs:///shared"
    assert ensure_checkpoint_dir(fake("local[2]")).startswith("/")
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(fake("yarn"))
