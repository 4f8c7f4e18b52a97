"""Join per-group statistics back onto the readings of each group.

The statistics side has one row per (keys, window), so its size grows with the number of groups,
not with the readings. It is broadcast only after its real size has been measured against the
session's broadcast threshold; beyond that, a shuffle join on the group columns runs, with Spark's
adaptive skew-join handling splitting a hot group's readings over many tasks.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import broadcast_limit, written

_PREFIX = "__grp_"
_UNKNOWN = 1 << 62
#: Bytes of a hash relation beside a row's own.
_ROW_OVERHEAD = 32
_FIXED = (T.BooleanType, T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType,
          T.DayTimeIntervalType, T.YearMonthIntervalType)
STRATEGIES = ("auto", "broadcast", "shuffle_hash", "shuffle_merge", "shuffle")


@dataclass(frozen=True)
class StatsSize:
    rows: int
    est_bytes: int
    limit: int
    partitions: int = 1

    @property
    def broadcast(self) -> bool:
        return 0 <= self.est_bytes <= self.limit and self.limit >= 0

    @property
    def strategy(self) -> str:
        """Broadcast when the whole table fits the threshold; a shuffled hash join when one
        shuffle partition of it does (Spark's own rule for hash-join builds); else sort-merge,
        which spills instead of holding a hash table."""
        if self.broadcast:
            return "broadcast"
        per_partition = self.est_bytes / max(1, self.partitions)
        return "shuffle_hash" if self.limit >= 0 and per_partition <= self.limit else "shuffle_merge"


def measure(stats: DataFrame) -> StatsSize:
    """Row count and an estimate of the hash relation's bytes of a (written) statistics table.

    One small job over the statistics: rows times fixed slots, plus the real bytes of string and
    binary columns. Never the readings. A table with a column whose size is not known this way
    (array, map, struct, variant) counts as too large to broadcast.
    """
    types = [f.dataType for f in stats.schema.fields]
    unknown = any(not isinstance(t, (*_FIXED, T.StringType, T.BinaryType)) for t in types)
    string_cols = [f.name for f in stats.schema.fields
                   if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.coalesce(F.sum(F.octet_length(F.col(c))), F.lit(0)).alias(f"b{i}")
             for i, c in enumerate(string_cols)]
    row = stats.agg(*aggs).first()
    rows = int(row["rows"])
    var_bytes = sum(int(row[f"b{i}"]) for i in range(len(string_cols)))
    wide = sum(isinstance(t, T.DecimalType) and t.precision > 18 for t in types)
    fixed = _ROW_OVERHEAD + 8 * len(types) + 16 * wide
    spark = stats.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    size = _UNKNOWN if unknown else rows * fixed + var_bytes
    return StatsSize(rows, size, broadcast_limit(spark), parts)


def attach_stats(readings: DataFrame, stats: DataFrame, on: list[str],
                 strategy: str = "auto", how: str = "inner",
                 is_written: bool = False) -> DataFrame:
    """Join ``stats`` (unique on ``on``) to ``readings`` (``inner`` or ``left``); group keys
    compare null-safe.

    ``strategy``: ``auto`` (measure, then broadcast, shuffled hash or sort-merge join; see
    :attr:`StatsSize.strategy`), or one of those forced: ``broadcast``, ``shuffle_hash``,
    ``shuffle_merge`` (``shuffle`` is sort-merge). The shuffle joins are hinted so the planner
    does not broadcast on its own estimate; adaptive execution splits skewed partitions.
    Duplicated readings stay duplicated: the statistics are unique on the join columns.

    ``auto`` runs jobs at once: it writes ``stats`` to the shared checkpoint folder (unless
    ``is_written`` says that they are read from written files) and measures that table, so the
    size check and the join see the same rows and nothing stays cached.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}")
    if readings.isStreaming or stats.isStreaming:
        raise ValueError("attach_stats is the batch path; streams use sigmawatch.streaming")
    if strategy == "auto" and not is_written:
        stats = written(stats, "stats")
    renamed = stats.select(*[F.col(c).alias(_PREFIX + c) for c in on],
                           *[c for c in stats.columns if c not in on])
    if strategy == "auto":
        strategy = measure(renamed).strategy
    if strategy == "broadcast":
        side = F.broadcast(renamed)
    else:
        side = renamed.hint("shuffle_hash" if strategy == "shuffle_hash" else "shuffle_merge")
    cond = reduce(lambda a, b: a & b,
                  [readings[c].eqNullSafe(side[_PREFIX + c]) for c in on])
    return readings.join(side, cond, how).drop(*[_PREFIX + c for c in on])
