"""Pieces of the DuckDB SQL that the registered queries are compared with."""

from __future__ import annotations


def bucket(width: str, col: str = "ts") -> str:
    """Start of the tumbling window of ``col``."""
    return f"time_bucket(INTERVAL '{width}', {col}, TIMESTAMP '1970-01-01 00:00:00')"


def anomaly_sql(key: str, width: str, k: float, where: str = "", extra: str = "",
                table: str = "events", more: str = "") -> str:
    """Readings beyond ``k`` deviations of their window, of the rows ``where`` leaves in ``table``;
    ``extra`` cuts the result, ``more`` adds columns to it."""
    return f"""
WITH b AS (
  SELECT {key}, event_id, ts, value, {bucket(width)} AS window_start FROM {table} {where}
), s AS (
  SELECT {key} AS s_key, window_start AS s_ws, count(value) AS n, avg(value) AS mean,
         stddev_pop(value) AS sd, min(value) AS lo, max(value) AS hi
  FROM b GROUP BY {key}, window_start
)
SELECT b.{key}, b.window_start, b.event_id, b.ts, b.value, s.n{more}
FROM b JOIN s ON b.{key} = s.s_key AND b.window_start = s.s_ws
WHERE s.n >= 2 AND s.hi > s.lo AND abs(b.value - s.mean) > {k} * s.sd {extra}
"""


def stats_sql(width: str) -> str:
    return f"""
SELECT event_type, {bucket(width)} AS window_start,
       {bucket(width)} + INTERVAL '{width}' AS window_end,
       count(value) AS n, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS stddev,
       min(value) AS lo, max(value) AS hi
FROM events GROUP BY ALL
"""


def closed(width: str, delay: str = "1 second", start: str = "b.window_start") -> str:
    """Whether a stream of all events has closed the window."""
    return f"{start} + INTERVAL '{width}' <= (SELECT max(ts) FROM events) - INTERVAL '{delay}'"
