"""Merge fine window statistics into coarser windows (Chan's parallel combination).

Input rows are the output of ``window_stats`` (``n, mean, m2, lo, hi`` per keys and fine window).
The merge first totals ``N`` and ``M`` per coarse group, then sums ``m2_i + n_i (mean_i - M)^2``.
A coarse group holds at most ``coarse / fine`` statistics rows, a bound set by the two window
sizes, never by the number of readings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import (
    HI, LO, M2, MEAN, N, STDDEV, WINDOW_END, WINDOW_START, merged_moments, tumbling_window,
)
from ..session import written
from .windows import as_keys


def merge_stats(stats: DataFrame, keys: str | Sequence[str], coarse_window: str) -> DataFrame:
    """Re-window fine statistics to ``coarse_window`` (a multiple of the fine size, epoch aligned).

    Writes the statistics once to the shared folder, finds the fine windows' size there and raises
    ``ValueError`` if they differ in size or the coarse size is not a multiple of it.
    """
    ks = as_keys(keys)
    # The check and the merge read what is written, so the readings are aggregated once.
    stats = written(stats.select(*ks, WINDOW_START, WINDOW_END, N, MEAN, M2, LO, HI), "merge-fine")
    coarse = tumbling_window(WINDOW_START, coarse_window)
    micros = "timestampdiff(MICROSECOND, {}, {})".format
    sizes = stats.select(F.expr(micros(WINDOW_START, WINDOW_END)).alias("f"), coarse.alias("w"))
    sizes = sizes.agg(F.min("f").alias("lo"), F.max("f").alias("hi"),
                      F.max(F.expr(micros("w.start", "w.end"))).alias("c")).first()
    if sizes["lo"] is not None and (sizes["lo"] != sizes["hi"] or sizes["c"] % sizes["lo"]):
        raise ValueError(f"windows of {sizes['lo']} to {sizes['hi']} microseconds do not add up to "
                         f"windows of {coarse_window}")
    fine = (stats.withColumn("__cw", coarse)
            .select(*ks, F.col("__cw.start").alias("__cs"), F.col("__cw.end").alias("__ce"),
                    N, MEAN, M2, LO, HI))
    part = Window.partitionBy(*ks, "__cs")
    # Both totals in one projection, so Spark computes them in a single Window operator.
    fine = fine.select("*", F.sum(N).over(part).alias("__N"),
                       F.sum(F.col(N) * F.col(MEAN)).over(part).alias("__S"))
    fine = fine.withColumn("__M", F.col("__S") / F.col("__N"))
    inner, between = merged_moments(N, MEAN, M2, F.col("__N"), F.col("__M"))
    merged = fine.groupBy(*ks, "__cs", "__ce").agg(
        F.max("__N").alias(N),
        F.max("__M").alias(MEAN),
        (F.sum(inner) + F.sum(between)).alias(M2),
        F.min(LO).alias(LO),
        F.max(HI).alias(HI),
    )
    return (merged.withColumnRenamed("__cs", WINDOW_START).withColumnRenamed("__ce", WINDOW_END)
            .withColumn(STDDEV, F.sqrt(F.col(M2) / F.col(N))))


def merge_parts(parts: DataFrame, group: list[str]) -> DataFrame:
    """Merge rows of partial moments (``n, mean, m2, lo, hi``) per ``group``: total count and mean in a first aggregate, the
    squares about that mean in a second. Both aggregate in the map tasks first, so a group with very
    many parts is never in one place."""
    total = parts.groupBy(*group).agg(
        F.sum(N).alias(N), (F.sum(F.col(N) * F.col(MEAN)) / F.sum(N)).alias(MEAN),
        F.min(LO).alias(LO), F.max(HI).alias(HI))
    both = parts.select(*[F.col(c).alias(f"__{c}") for c in group], F.col(N).alias("__n"),
                        F.col(MEAN).alias("__mean"), F.col(M2).alias("__m2"))
    same = F.lit(True)
    for c in group:
        same = same & total[c].eqNullSafe(both[f"__{c}"])
    inner, between = merged_moments("__n", "__mean", "__m2", F.col(N), F.col(MEAN))
    merged = (total.join(both, same).groupBy(*group)
              .agg(F.any_value(N).alias(N), F.any_value(MEAN).alias(MEAN),
                   (F.sum(inner) + F.sum(between)).alias(M2), F.any_value(LO).alias(LO), F.any_value(HI).alias(HI)))
    return merged.withColumn(STDDEV, F.sqrt(F.col(M2) / F.col(N)))
