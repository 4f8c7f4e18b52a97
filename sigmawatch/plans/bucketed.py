"""An archive bucketed by key, over which detection does not shuffle readings.

Beyond the broadcast threshold the readings of an unbucketed table cross one shuffle to meet their
statistics, every time detection runs. Here they are shuffled once, when they are archived: the table
is bucketed by a hash of the keys and a salt, so the aggregate and the join read buckets as they are.
The salt, a hash of the row, spreads each key over several buckets, so a key that holds a third of
all readings does not fill one. Only statistics are exchanged: a key's partial moments of all its
salts are merged, and the merged statistics are copied to each salt.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.stats import (
    DEFAULT_K, HI, LO, M2, WINDOW_END, WINDOW_START, deviates, group_can_flag, moment_aggs, STDDEV,
)
from ..operators.attach import attach_stats, measure
from ..operators.merge import merge_parts
from ..operators.windows import as_keys, assign_windows, check_columns
from ..session import scratch_path, written

SALT, BUCKET = "__salt", "__bucket"
DEFAULT_SALTS = 16
#: Lets a join use buckets of one of its columns; Spark asks for all of them by default.
_SUBSET = "spark.sql.requireAllClusterKeysForCoPartition"


def archive_bucketed(readings: DataFrame, table: str, keys: str | Sequence[str], buckets: int,
                     salts: int = DEFAULT_SALTS, path: str | None = None, mode: str = "error") -> None:
    """Write ``readings`` as the catalog table ``table`` (files at ``path`` if given), bucketed.

    One task writes one bucket, as one file: choose ``buckets`` for the size a task should read, about
    the table's bytes over 128 MB. ``salts`` bounds the share of one key in a bucket.
    """
    ks = as_keys(keys)
    salt = F.pmod(F.xxhash64(*readings.columns), F.lit(int(salts))).cast("int")
    dealt = readings.withColumn(SALT, salt).withColumn(BUCKET, F.xxhash64(*ks, SALT))
    # The shuffle's hash is the buckets' own.
    writer = (dealt.repartition(int(buckets), BUCKET).write.mode(mode).bucketBy(int(buckets), BUCKET)
              .option("salts", str(int(salts))))
    (writer.option("path", path) if path else writer).saveAsTable(table)


def detect_bucketed(archived: DataFrame, keys: str | Sequence[str], time_col: str, value_col: str,
                    window: str = "1 minute", k: float = DEFAULT_K, salts: int = DEFAULT_SALTS,
                    stats_join: str = "auto") -> DataFrame:
    """:func:`detect` over a table of :func:`archive_bucketed` (same ``keys`` and ``salts``), whose
    readings stay in their buckets. ``stats_join``: ``auto`` broadcasts the statistics where their
    measured size allows, else joins bucket by bucket (``shuffle_hash``, ``shuffle_merge``).

    Sets the session's ``spark.sql.requireAllClusterKeysForCoPartition`` to false: without it Spark
    shuffles the readings by all columns of the join.
    """
    ks = as_keys(keys)
    check_columns(archived, ks, time_col, value_col)
    missing = [c for c in (SALT, BUCKET) if c not in archived.columns]
    if missing:
        raise ValueError(f"not a bucketed archive: no column {missing}")
    archived.sparkSession.conf.set(_SUBSET, "false")
    base = assign_windows(archived, time_col, window)
    group = [*ks, WINDOW_START, WINDOW_END]
    partial = base.groupBy(BUCKET, *group).agg(*moment_aggs(F.col(value_col).cast("double")))
    partial = written(partial.drop(BUCKET, STDDEV), "bucket-parts")
    candidates = written(merge_parts(partial, group).filter(group_can_flag(k)).drop(M2, LO, HI, WINDOW_END),
                         "bucket-stats")
    if stats_join == "auto":
        stats_join = measure(candidates).strategy
    if stats_join == "broadcast":
        found = attach_stats(base, candidates, [*ks, WINDOW_START], "broadcast")
    else:
        copies = candidates.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(int(salts) - 1))))
        copies = copies.withColumn(BUCKET, F.xxhash64(*ks, SALT)).drop(SALT)
        renamed = copies.select(*[F.col(c).alias(f"__s_{c}") for c in (BUCKET, *ks, WINDOW_START)],
                                *[c for c in copies.columns if c not in (BUCKET, *ks, WINDOW_START)])
        same = (base[BUCKET] == renamed[f"__s_{BUCKET}"]) & (base[WINDOW_START] == renamed[f"__s_{WINDOW_START}"])
        for c in ks:
            same = same & base[c].eqNullSafe(renamed[f"__s_{c}"])
        found = base.join(renamed.hint(stats_join), same)
        found = found.drop(*[c for c in found.columns if c.startswith("__s_")])
    return found.filter(deviates(value_col, k)).drop(SALT, BUCKET)


def bucketed_copy(spark: SparkSession, readings: DataFrame, keys: str | Sequence[str], buckets: int,
                  salts: int = DEFAULT_SALTS) -> DataFrame:
    """``readings`` in buckets below the shared folder, read back. The table leaves the catalog again
    once it is read; its files stay."""
    path = scratch_path(spark, "bucketed")
    name = "bucketed_" + path.rsplit("-", 1)[-1]
    archive_bucketed(readings, name, keys, buckets, salts, path)
    archived = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return archived
