"""Column expressions for windowed moments and the k-sigma outlier test.

Everything here is a built-in Spark expression, so it stays inside whole-stage codegen and
Spark's partial (map-side) aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of the columns the operators add to a reading row. Fixed so every shape agrees.
WINDOW_START = "window_start"
WINDOW_END = "window_end"
N, MEAN, STDDEV, M2, LO, HI = "n", "mean", "stddev", "m2", "lo", "hi"
RESERVED = (WINDOW_START, WINDOW_END, N, MEAN, STDDEV, M2, LO, HI)

DEFAULT_K = 3.0
MIN_READINGS = 2


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tumbling_window(time_col: str | Column, duration: str) -> Column:
    """Epoch-aligned tumbling event-time window ``[start, end)``, as Spark's ``window``."""
    return F.window(col_of(time_col), duration)


def moment_aggs(value_col: str | Column) -> list[Column]:
    """Per-group count, mean, population variance pieces and range, in one aggregate.

    ``var_pop`` is Spark's central-moment aggregate: an incremental (Welford) update per row and
    a pairwise (Chan) merge of partial buffers, so a hot group is pre-aggregated in every map task.
    ``min``/``max`` feed the zero-spread guard: ``avg`` (a plain sum) and the moment update can
    disagree in the last digit on identical readings, so spread is decided by ``hi > lo``.
    """
    v = col_of(value_col)
    var = F.var_pop(v)
    n = F.count(v)
    return [
        n.alias(N),
        F.avg(v).alias(MEAN),
        F.sqrt(var).alias(STDDEV),
        (var * n).alias(M2),
        F.min(v).alias(LO),
        F.max(v).alias(HI),
    ]


def deviates(value_col: str | Column, k: float = DEFAULT_K, mean: str | Column = MEAN,
             stddev: str | Column = STDDEV) -> Column:
    """``|x - mean| > k * stddev``: the per-reading part of :func:`is_outlier`, for readings of
    groups that already passed :func:`group_can_flag`."""
    return F.abs(col_of(value_col) - col_of(mean)) > F.lit(float(k)) * col_of(stddev)


def is_outlier(value_col: str | Column, k: float = DEFAULT_K,
               n: str | Column = N, mean: str | Column = MEAN, stddev: str | Column = STDDEV,
               lo: str | Column = LO, hi: str | Column = HI) -> Column:
    """``|x - mean| > k * stddev`` with at least two readings and a non-zero spread."""
    v = col_of(value_col)
    return (
        (col_of(n) >= F.lit(MIN_READINGS))
        & (col_of(hi) > col_of(lo))
        & (F.abs(v - col_of(mean)) > F.lit(float(k)) * col_of(stddev))
    )


def group_can_flag(k: float = DEFAULT_K, n: str | Column = N, mean: str | Column = MEAN,
                   stddev: str | Column = STDDEV, lo: str | Column = LO,
                   hi: str | Column = HI) -> Column:
    """True exactly for the groups holding at least one outlier, from their statistics alone.

    The reading farthest from the mean is the minimum or the maximum, and floating-point
    subtraction is monotone, so ``|x - mean| <= max(|hi - mean|, |lo - mean|)`` holds as
    computed for every ``x`` in ``[lo, hi]``: testing the two extremes with the same expression
    as :func:`is_outlier` decides the group exactly. Groups failing it need not meet their
    readings at all.
    """
    limit = F.lit(float(k)) * col_of(stddev)
    m = col_of(mean)
    return ((col_of(n) >= F.lit(MIN_READINGS)) & (col_of(hi) > col_of(lo))
            & ((F.abs(col_of(hi) - m) > limit) | (F.abs(col_of(lo) - m) > limit)))


def merged_moments(n: str | Column, mean: str | Column, m2: str | Column,
                   total_n: Column, total_mean: Column) -> tuple[Column, Column]:
    """Pieces of Chan's merge of partial moments, to be summed over the parts of a group.

    For parts ``(n_i, mean_i, m2_i)`` with merged count ``N`` and mean ``M``:
    ``M2 = sum(m2_i) + sum(n_i * (mean_i - M)^2)``. Returns ``(m2_i, n_i * (mean_i - M)^2)``.
    """
    d = col_of(mean) - total_mean
    return col_of(m2), col_of(n) * d * d
