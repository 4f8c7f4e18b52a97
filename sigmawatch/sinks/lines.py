"""Anomaly sinks: the console line of each anomaly, printed or written as text.

Printing is for small outputs: it takes a bounded number of rows to the driver and refuses more.
For anything larger the tasks write the lines as text files, in a stream one folder per micro-batch.
"""

from __future__ import annotations

import sys
from typing import TextIO

from pyspark.sql import DataFrame, SparkSession

from ..functions.format import anomaly_line

LINE = "line"
#: Lines that may be printed unless the caller sets another bound.
PRINT_LIMIT = 10_000


def with_lines(anomalies: DataFrame, device_col: str = "deviceId", value_col: str = "temperatureC",
               millis_col: str = "timestampMillis") -> DataFrame:
    """Add the ``line`` column: ``Device <id>, measurement <x.x> C, time <millis>``."""
    return anomalies.withColumn(LINE, anomaly_line(device_col, value_col, millis_col))


def print_lines(anomalies: DataFrame, out: TextIO | None = None, limit: int = PRINT_LIMIT, **cols) -> int:
    """Print one verbatim line per anomaly (no prefix); returns the number printed.

    At most ``limit`` rows come to the driver. If there are more, nothing is printed and a
    ``ValueError`` says so: write them as files instead (:func:`write_lines`).
    """
    out = out or sys.stdout
    rows = with_lines(anomalies, **cols).select(LINE).take(int(limit) + 1)
    if len(rows) > limit:
        raise ValueError(f"more than {limit} lines to print: write them as files, or set a higher limit")
    for row in rows:
        out.write(row[LINE] + "\n")
    out.flush()
    return len(rows)


def write_lines(anomalies: DataFrame, path: str, mode: str = "error", **cols) -> None:
    """Write the anomaly lines as text files, one task per output file."""
    with_lines(anomalies, **cols).select(LINE).write.mode(mode).text(path)


def console_batch_writer(out: TextIO | None = None, limit: int = PRINT_LIMIT, **cols):
    """A ``foreachBatch`` function printing each micro-batch's anomaly lines."""
    def write(batch: DataFrame, batch_id: int) -> None:
        print_lines(batch, out=out, limit=limit, **cols)
    return write


def line_batch_writer(path: str, **cols):
    """A ``foreachBatch`` function that writes each micro-batch's lines to a folder of its own below
    ``path``, from the tasks. A batch that is run again, as after a failure, replaces its folder, so
    every line is there once."""
    def write(batch: DataFrame, batch_id: int) -> None:
        lines = with_lines(batch, **cols).select(LINE)
        lines.write.mode("overwrite").text(f"{path.rstrip('/')}/batch={int(batch_id)}")
    return write


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines that :func:`line_batch_writer` wrote: ``line`` and its ``batch``."""
    return spark.read.text(path).withColumnRenamed("value", LINE)
