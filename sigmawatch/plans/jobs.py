"""The reference's three runnable jobs as functions (and a small command line).

* ``detect_file``: JSON-lines readings -> per device, 1-minute windows -> console lines.
  ``method='two_pass'`` is the buffered textbook job, ``'incremental'`` the running-moment one.

* ``watch_folder``: the same pipeline as a stream over JSON-lines files arriving in a folder.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from ..functions.stats import DEFAULT_K
from ..operators.detect import detect
from ..sinks.lines import print_lines, write_lines
from ..sources.readings import read_jsonl, with_event_time

DEFAULT_WINDOW = "1 minute"


def anomalies_of_readings(readings: DataFrame, window: str = DEFAULT_WINDOW, k: float = DEFAULT_K,
                          method: str = "incremental") -> DataFrame:
    """Detection on reading rows (``deviceId, temperatureC, timestampMillis[, ts]``)."""
    if "ts" not in readings.columns:
        readings = with_event_time(readings)
    return detect(readings, "deviceId", "ts", "temperatureC", window, k, method)


def _emit(anomalies: DataFrame, out_path: str | None) -> int | None:
    if out_path:
        write_lines(anomalies, out_path)
        return None
    return print_lines(anomalies)


def detect_file(spark: SparkSession, path: str, window: str = DEFAULT_WINDOW, k: float = DEFAULT_K,
                method: str = "two_pass", out_path: str | None = None) -> int | None:
    readings = read_jsonl(spark, path)
    return _emit(anomalies_of_readings(readings, window, k, method), out_path)


def watch_folder(spark: SparkSession, path: str, checkpoint: str, window: str = DEFAULT_WINDOW,
                 k: float = DEFAULT_K, available_now: bool = False, out=None):
    """The reference's pipeline as a stream: JSON-lines files arriving in ``path`` -> 1 s
    watermark -> per device and window -> console lines, restartable from ``checkpoint``."""
    from ..sources.readings import read_jsonl_stream
    from ..streaming.detect_stream import detect_stream, start_to_console

    found = detect_stream(read_jsonl_stream(spark, path), "deviceId", "ts", "temperatureC",
                          window, k)
    return start_to_console(found, checkpoint, available_now=available_now, out=out)


def main(argv: list[str] | None = None) -> int:
    from ..session import local_session

    ap = argparse.ArgumentParser(prog="python -m sigmawatch.plans.jobs")
    sub = ap.add_subparsers(dest="job", required=True)
    f = sub.add_parser("file", help="detect on a JSON-lines file")
    f.add_argument("path")
    f.add_argument("--method", choices=["two_pass", "incremental"], default="two_pass")
    f.add_argument("--out", default=None, help="write lines as text files instead of printing")
    w = sub.add_parser("watch", help="detect on JSON-lines files arriving in a folder (a stream)")
    w.add_argument("path")
    w.add_argument("checkpoint")
    w.add_argument("--once", action="store_true", help="process what is there, then stop")
    args = ap.parse_args(argv)
    spark = local_session()
    if args.job == "watch":
        watch_folder(spark, args.path, args.checkpoint, available_now=args.once).awaitTermination()
    else:
        detect_file(spark, args.path, method=args.method, out_path=args.out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
