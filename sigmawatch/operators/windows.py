"""Window assignment and per-(keys, window) statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import RESERVED, WINDOW_END, WINDOW_START, moment_aggs, tumbling_window


def as_keys(keys: str | Sequence[str]) -> list[str]:
    out = [keys] if isinstance(keys, str) else list(keys)
    if not out:
        raise ValueError("at least one key column is needed (statistics are per key, never global)")
    return out


def check_columns(df: DataFrame, keys: list[str], *others: str) -> None:
    missing = [c for c in [*keys, *others] if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")
    clash = [c for c in df.columns if c in RESERVED]
    if clash:
        raise ValueError(f"input columns {clash} clash with the operator's output names")


def assign_windows(df: DataFrame, time_col: str, window: str) -> DataFrame:
    """Add ``window_start``/``window_end`` of the tumbling event-time window of each row.

    The window is materialised as plain columns once, so later grouping and joining on
    ``window_start`` share one partitioning instead of re-deriving the window struct.
    """
    w = tumbling_window(time_col, window)
    return df.withColumn("__w", w).select(
        *df.columns,
        F.col("__w.start").alias(WINDOW_START),
        F.col("__w.end").alias(WINDOW_END),
    )


def window_stats(df: DataFrame, keys: str | Sequence[str], time_col: str, value_col: str,
                 window: str = "1 minute") -> DataFrame:
    """One row per (keys, window): ``n, mean, stddev`` (population), ``m2, lo, hi``.

    A plain ``groupBy``: Spark pre-aggregates in every map task, so a key holding a third of
    all rows sends one partial row per task through the shuffle, not its readings.
    """
    ks = as_keys(keys)
    check_columns(df, ks, time_col, value_col)
    base = assign_windows(df.select(*ks, time_col, value_col), time_col, window)
    return base.groupBy(*ks, WINDOW_START, WINDOW_END).agg(*moment_aggs(value_col))
