"""The console line of one anomaly, and zone-independent epoch conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .stats import col_of

# The output line of the reference, with a US-locale decimal point.
LINE_FORMAT = "Device %s, measurement %.1f C, time %d"
# Generated device ids.
DEVICE_ID_FORMAT = "device-%04d"



def anomaly_line(device_col: str | Column, value_col: str | Column, millis_col: str | Column) -> Column:
    """``Device <id>, measurement <x.x> C, time <millis>``.

    ``format_string`` rounds ``%.1f`` half-up on the decimal text of the double (0.25 -> 0.3).
    """
    return F.format_string(LINE_FORMAT, col_of(device_col).cast("string"),
                           col_of(value_col).cast("double"), col_of(millis_col).cast("long"))


def device_id(index_col: str | Column) -> Column:
    """``device-%04d`` of an integer index. Zero-padding through ``lpad`` is the same text as
    ``format_string`` for non-negative indexes (wider numbers print whole) and about four
    times cheaper per row; negative indexes take the ``format_string`` path."""
    i = col_of(index_col).cast("long")
    digits = i.cast("string")
    return (F.when(i >= 10_000, F.concat(F.lit("device-"), digits))
            .when(i >= 0, F.concat(F.lit("device-"), F.lpad(digits, 4, "0")))
            .otherwise(F.format_string(DEVICE_ID_FORMAT, i)))


def epoch_millis(ts_col: str | Column, dtype: T.DataType) -> Column:
    """Epoch milliseconds (floor) of an event-time column, independent of the session zone.

    TIMESTAMP is an instant; TIMESTAMP_NTZ is read as UTC wall-clock time (how the driver tables
    are written); integral columns are taken to be epoch milliseconds already.
    """
    c = col_of(ts_col)
    if isinstance(dtype, T.TimestampNTZType):
        micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)
    elif isinstance(dtype, T.TimestampType):
        micros = F.unix_micros(c)
    elif isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType)):
        return c.cast("long")
    else:
        raise TypeError(f"not an event-time type: {dtype.simpleString()}")
    return ((micros - F.pmod(micros, F.lit(1000))) / F.lit(1000)).cast("long")
