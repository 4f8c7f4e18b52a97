"""Windowed detection as a stateful function with timers.

One state per (keys, window): a list of the window's readings, row by row, and their running moments.
The first reading sets an event-time timer at the window's end; when the watermark passes it, the
function reads the list once, emits the outliers and clears its state. The list lives in RocksDB and
is appended to and read piece by piece, so a hot group needs disk, not memory. A group is one task's
work here; the salted join of :func:`detect_stream` spreads a hot group over several, so prefer that
for skewed keys.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import islice

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.durations import duration_millis
from ..functions.stats import DEFAULT_K, MEAN, MIN_READINGS, N, STDDEV, WINDOW_END, WINDOW_START, tumbling_window
from ..operators.windows import as_keys, check_columns
from .detect_stream import DEFAULT_DELAY, _as_ntz, _event_time, ensure_disk_state

_MOMENTS = "n long, mean double, m2 double, lo double, hi double"
#: Readings appended to a state at a time.
APPEND_ROWS = 1_000


class WindowOutliers(StatefulProcessor):
    """Outliers of one (keys, window) group. The grouping columns are ``n_keys`` keys and the
    window's end in epoch milliseconds; ``row`` is the schema of a reading, ``out`` the result's names."""

    def __init__(self, row: T.StructType, out: list[str], value_col: str, n_keys: int, k: float) -> None:
        self.row, self.out, self.value_at = row, out, row.names.index(value_col)
        self.n_keys, self.k = n_keys, k

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.readings = handle.getListState("readings", self.row)
        self.moments = handle.getValueState("moments", _MOMENTS)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        end, known = int(key[self.n_keys]), self.moments.exists()
        if not known and end <= timerValues.getCurrentWatermarkInMs():
            return  # late: the window has closed
        n, mean, m2, lo, hi = self.moments.get() if known else (0, 0.0, 0.0, 0.0, 0.0)
        while piece := [tuple(r[c] for c in self.row.names) for r in islice(rows, APPEND_ROWS)]:
            self.readings.appendList(piece)
            for reading in piece:
                value = reading[self.value_at]
                if value is None:
                    continue
                value = float(value)
                lo, hi = (min(lo, value), max(hi, value)) if n else (value, value)
                n += 1
                step = value - mean
                mean += step / n
                m2 += step * (value - mean)
        self.moments.update((n, mean, m2, lo, hi))
        if not known:
            self.handle.registerTimer(end)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        n, mean, m2, lo, hi = self.moments.get()
        if n >= MIN_READINGS and hi > lo:
            deviation = (m2 / n) ** 0.5
            for reading in self.readings.get():
                value = reading[self.value_at]
                if value is not None and abs(float(value) - mean) > self.k * deviation:
                    yield Row(**dict(zip(self.out, (*key, *reading, n, mean, deviation), strict=True)))
        self.readings.clear()
        self.moments.clear()

    def close(self) -> None:
        pass


def detect_with_timers(readings: DataFrame, keys: str | Sequence[str], time_col: str, value_col: str,
                       window: str = "1 minute", k: float = DEFAULT_K,
                       delay: str = DEFAULT_DELAY) -> DataFrame:
    """Streaming detection by a stateful function; rows as :func:`detect_stream` gives them.

    A reading is late if the watermark has reached its window's end and the window holds no reading
    that waits (one that does closes after this batch). Null keys are groups like any other; a null
    value is no reading. ``window`` is in whole milliseconds.
    """
    if not readings.isStreaming:
        raise ValueError("batch input: use sigmawatch.operators.detect")
    ks = as_keys(keys)
    check_columns(readings, ks, time_col, value_col)
    ensure_disk_state(readings.sparkSession)
    df, et, ntz = _event_time(readings, time_col)
    df = df.withWatermark(et, delay)
    # Times wait as epoch microseconds: exact in Python, whatever the session zone.
    kinds = {f.name: f.dataType for f in readings.schema.fields}
    epoch = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")

    def packed(name: str):
        if isinstance(kinds[name], T.TimestampNTZType):
            return F.timestamp_diff("MICROSECOND", epoch, F.col(name)).alias(name)
        return F.unix_micros(name).alias(name) if isinstance(kinds[name], T.TimestampType) else F.col(name)

    def unpacked(name: str):
        if not isinstance(kinds[name], (T.TimestampType, T.TimestampNTZType)):
            return F.col(name)
        at = F.timestamp_micros(F.col(name))
        return (_as_ntz(at) if isinstance(kinds[name], T.TimestampNTZType) else at).alias(name)

    by = [*(f"__k{i}" for i in range(len(ks))), "__end"]
    flat = df.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(ks)],
                     F.unix_millis(tumbling_window(et, window)["end"]).alias("__end"),
                     *[packed(c) for c in readings.columns])
    row = T.StructType([flat.schema[c] for c in readings.columns])
    out = T.StructType([*[flat.schema[c] for c in by], *row.fields, T.StructField(N, T.LongType()),
                        T.StructField(MEAN, T.DoubleType()), T.StructField(STDDEV, T.DoubleType())])
    found = flat.groupBy(*by).transformWithState(
        WindowOutliers(row, out.names, value_col, len(ks), float(k)), outputStructType=out, outputMode="append",
        timeMode="eventTime")
    start = F.timestamp_millis(F.col("__end") - F.lit(duration_millis(window)))
    stop = F.timestamp_millis(F.col("__end"))
    if ntz:
        start, stop = _as_ntz(start), _as_ntz(stop)
    return found.select(*[unpacked(c) for c in readings.columns], start.alias(WINDOW_START),
                        stop.alias(WINDOW_END), N, MEAN, STDDEV)
