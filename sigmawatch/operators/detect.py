"""Per-key, per-window k-sigma outlier detection on batch DataFrames.

Two shapes compute the same answer:

* ``incremental`` (default): one aggregate per (keys, window) with Spark's incremental
  central-moment aggregate, then one pass that joins the statistics back and flags readings.
* ``two_pass``: the textbook definition: a mean pass, a pass summing squared deviations from
  that mean, then the flag pass. No running update; beyond the broadcast threshold the readings
  are shuffled twice, so this shape is for comparison and ``incremental`` for large data.

Neither shape gathers a group's readings in one place: the statistics are aggregates (partial
aggregation absorbs hot keys) and the readings meet them through a join (broadcast after a size
check, else a shuffle join whose skewed partitions adaptive execution splits).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import (
    DEFAULT_K, HI, LO, M2, MEAN, N, STDDEV, WINDOW_START, deviates, group_can_flag, is_outlier,
    moment_aggs,
)
from ..session import written
from .attach import attach_stats
from .windows import as_keys, assign_windows, check_columns

METHODS = ("incremental", "two_pass")


def group_stats(base: DataFrame, group: list[str], value_col: str, method: str = "incremental",
                stats_join: str = "auto") -> DataFrame:
    """``n, mean, stddev, lo, hi`` per group of a windowed reading table, by either shape."""
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    if method == "incremental":
        return base.groupBy(*group).agg(*moment_aggs(F.col(value_col).cast("double"))).drop(M2)
    v = F.col(value_col).cast("double")
    means = base.groupBy(*group).agg(
        F.count(v).alias(N), F.avg(v).alias(MEAN), F.min(v).alias(LO), F.max(v).alias(HI))
    # Pass 2 reads the readings again with their group's mean attached and carries the first
    # pass's figures, equal within a group, through its aggregate.
    pass2 = base.select(*group, v.alias("__x"))
    with_mean = attach_stats(pass2, means, group, stats_join)
    deviation = F.col("__x") - F.col(MEAN)
    carried = [F.any_value(c).alias(c) for c in (N, MEAN, LO, HI)]
    squares = with_mean.groupBy(*group).agg(F.sum(deviation * deviation).alias("__ss"), *carried)
    return squares.withColumn(STDDEV, F.sqrt(F.col("__ss") / F.col(N))).drop("__ss")


def flag(base: DataFrame, stats: DataFrame, group: list[str], value_col: str, k: float,
         stats_join: str = "auto", keep_all: bool = False, is_written: bool = False) -> DataFrame:
    """Readings of ``base`` with their group's statistics; only outliers unless ``keep_all``
    (then an ``is_outlier`` column marks them). ``is_written``: see :func:`attach_stats`."""
    if keep_all:
        joined = attach_stats(base, stats, group, stats_join, is_written=is_written)
        return joined.withColumn("is_outlier", is_outlier(value_col, k))
    # Only groups with an outlier meet their readings: a smaller table to measure, broadcast or
    # shuffle, and the other groups' readings are dropped at the join's probe. Those groups have
    # n >= 2 and hi > lo, so the range columns stay behind and each reading is tested only for
    # its deviation.
    candidates = stats.filter(group_can_flag(k)).drop(LO, HI)
    return attach_stats(base, candidates, group, stats_join, is_written=is_written).filter(deviates(value_col, k))


def detect(df: DataFrame, keys: str | Sequence[str], time_col: str, value_col: str,
           window: str = "1 minute", k: float = DEFAULT_K, method: str = "incremental",
           stats_join: str = "auto") -> DataFrame:
    """Readings more than ``k`` population deviations from their own (keys, window) mean.

    Returns every input column of the flagged rows plus ``window_start, window_end, n, mean,
    stddev``. A window with fewer than two readings or with all readings equal flags nothing;
    a reading is part of its own baseline; duplicates count and are reported each time.

    ``stats_join`` picks how statistics meet readings (see :func:`attach_stats`): ``auto``
    measures the statistics and broadcasts them only when they fit the session's threshold. With
    it this function runs jobs while the result is being built (the statistics are written to the
    shared checkpoint folder); the statistics are computed from the input as it is at the call.
    """
    base, group = _prepare(df, keys, time_col, value_col, window, k)
    stats = group_stats(base, group, value_col, method, stats_join)
    joined = flag(base, stats, group, value_col, k, stats_join)
    return (joined.select(*df.columns, *[c for c in joined.columns if c not in df.columns])
            .drop(LO, HI))


def _prepare(df: DataFrame, keys, time_col: str, value_col: str, window: str, k: float):
    if df.isStreaming:
        raise ValueError("streaming input: use sigmawatch.streaming.detect_stream")
    ks = as_keys(keys)
    check_columns(df, ks, time_col, value_col)
    if not float(k) >= 0:
        raise ValueError("k must be a non-negative number")
    return assign_windows(df, time_col, window), [*ks, WINDOW_START]


def flag_counts(df: DataFrame, keys: str | Sequence[str], time_col: str, value_col: str,
                window: str = "1 minute", k: float = DEFAULT_K,
                method: str = "incremental") -> DataFrame:
    """Per (keys, window): reading count and number of flagged readings (0 where none).

    The statistics are computed and written once; the (few) flagged rows are counted per group and
    joined back to them, so the readings are read twice and never shuffled for the counting.
    """
    base, group = _prepare(df, keys, time_col, value_col, window, k)
    stats = written(group_stats(base, group, value_col, method), "group-stats")
    flagged = (flag(base, stats, group, value_col, k, is_written=True)
               .groupBy(*group).agg(F.count(F.lit(1)).alias("n_flagged")))
    # Both sides have a row per group at most: nothing to measure or to write again.
    out = attach_stats(stats.select(*group, N), flagged, group, "shuffle_merge", how="left")
    return out.select(*group, N, F.coalesce(F.col("n_flagged"), F.lit(0)).alias("n_flagged"))
