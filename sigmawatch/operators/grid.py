"""Detection under many settings with one scan for statistics and one join.

Replaying readings under other windows and thresholds need not read them once per setting. One
aggregate over the readings gives partial moments per (keys, finest window), the finest being the
greatest common divisor of the window sizes. Every window's statistics are rolled up from these
rows. Then each fine group gets, side by side, the statistics of the window of each size that it lies
in, and one join brings that row to the group's readings; a reading is tested against all of them at
once. Whatever the number of settings, the readings are read twice.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import gcd

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.durations import duration_millis
from ..functions.stats import (
    HI, LO, M2, MEAN, N, STDDEV, WINDOW_END, WINDOW_START, group_can_flag, moment_aggs, tumbling_window,
)
from ..session import written
from .attach import attach_stats
from .merge import merge_parts
from .windows import as_keys, check_columns

WINDOW, SIGMA = "window", "k"
_FINE = "__fine"


def detect_grid(df: DataFrame, keys: str | Sequence[str], time_col: str, value_col: str,
                windows: Sequence[str], sigmas: Sequence[float], stats_join: str = "auto") -> DataFrame:
    """Outliers for every pair of ``windows`` and ``sigmas``: the rows of :func:`detect` for each,
    with ``window`` (as given) and ``k`` added.

    Means and deviations are merged from fine windows (Chan), so they may differ from
    :func:`detect`'s in the last digits. Statistics are written to the shared folder at the call.
    """
    if df.isStreaming:
        raise ValueError("streaming input: use sigmawatch.streaming.detect_stream")
    ks = as_keys(keys)
    check_columns(df, ks, time_col, value_col)
    clash = [c for c in df.columns if c in (WINDOW, SIGMA, _FINE)]
    if clash:
        raise ValueError(f"input columns {clash} clash with the operator's output names")
    if not windows or not sigmas or not all(float(k) >= 0 for k in sigmas):
        raise ValueError("windows and non-negative sigmas are needed")
    fine = f"{reduce(gcd, map(duration_millis, windows))} milliseconds"
    base = df.withColumn(_FINE, tumbling_window(time_col, fine)["start"])
    value = F.col(value_col).cast("double")
    stats = written(base.groupBy(*ks, _FINE).agg(*moment_aggs(value)).drop(STDDEV), "grid-fine")
    lowest = min(map(float, sigmas))
    wide = stats.select(*ks, _FINE)
    for i, size in enumerate(windows):
        placed = stats.withColumn("__w", tumbling_window(_FINE, size)).select(
            *ks, F.col("__w.start").alias(WINDOW_START), F.col("__w.end").alias(WINDOW_END), N, MEAN, M2, LO, HI)
        rolled = merge_parts(placed, [*ks, WINDOW_START, WINDOW_END]).filter(group_can_flag(lowest))
        rolled = rolled.select(*[F.col(c).alias(f"__r_{c}") for c in ks], F.col(WINDOW_START).alias(f"__start{i}"),
                               F.col(WINDOW_END).alias(f"__end{i}"), F.col(N).alias(f"__n{i}"),
                               F.col(MEAN).alias(f"__mean{i}"), F.col(STDDEV).alias(f"__sd{i}"))
        wide = wide.withColumn("__w", tumbling_window(_FINE, size)).withColumn("__in", F.col("__w.start")).drop("__w")
        same = F.col("__in") == F.col(f"__start{i}")
        for c in ks:
            same = same & wide[c].eqNullSafe(rolled[f"__r_{c}"])
        wide = wide.join(rolled, same, "left").drop("__in", *[f"__r_{c}" for c in ks])
    some = reduce(lambda a, b: a | b, [F.col(f"__start{i}").isNotNull() for i in range(len(windows))])
    joined = attach_stats(base, wide.filter(some), [*ks, _FINE], stats_join)

    def hit(i: int, size: str, k: float):
        far = F.abs(value - F.col(f"__mean{i}")) > F.lit(float(k)) * F.col(f"__sd{i}")
        return F.when(far, F.struct(
            F.lit(size).alias(WINDOW), F.lit(float(k)).alias(SIGMA), F.col(f"__start{i}").alias(WINDOW_START),
            F.col(f"__end{i}").alias(WINDOW_END), F.col(f"__n{i}").alias(N), F.col(f"__mean{i}").alias(MEAN),
            F.col(f"__sd{i}").alias(STDDEV)))

    hits = F.array(*[hit(i, w, k) for i, w in enumerate(windows) for k in sigmas])
    found = joined.select(*df.columns, F.explode(F.array_compact(hits)).alias("__hit"))
    return found.select(*df.columns, "__hit.*")
