"""Session helpers: a tuned local session for tests and the bench, and the shared scratch folder.

Library code never builds its own session; it takes the caller's. The only thing it reads from
the session is ``spark.checkpoint.dir``, the shared folder where written intermediates go.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
          "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "sigmawatch", extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench. On a cluster, use the cluster's session instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        # Streaming state in RocksDB (spills to disk, changelog commits); join state format 3
        # keeps both of a join side's stores in one RocksDB instance per partition.
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
        .config("spark.sql.streaming.join.stateFormatVersion", "3")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; sets a fresh one only where none is set."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local($|\[)", sc.master):
            # A machine-local folder is not shared by the executors of a cluster.
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, object store) "
                               "for the intermediates this job writes")
        # Local runs and tests only.
        configured = tempfile.mkdtemp(prefix="sigmawatch-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder for written intermediates."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/sigmawatch/{purpose}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to a fresh folder below the shared checkpoint folder and read back.

    The folder is unique, so no cached or earlier result can stand in for the rows, nothing needs
    to be released, and the files outlive the executors that wrote them.
    """
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def byte_size(text: str | None, default: int) -> int:
    """Parse a Spark byte-size setting such as ``10MB``, ``10485760b`` or ``-1``."""
    if text is None:
        return default
    match = re.fullmatch(r"\s*(-?\d+)\s*([a-zA-Z]*)\s*", str(text))
    if not match:
        return default
    number, unit = int(match.group(1)), match.group(2).lower()
    if number < 0:
        return -1
    return number * _UNITS.get(unit, 1)


def broadcast_limit(spark: SparkSession) -> int:
    """Largest build side (bytes) we broadcast: the session's auto-broadcast threshold."""
    return byte_size(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10MB"), 10 << 20)

