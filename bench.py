"""Bench: headline queries on $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS].

Each query runs once to warm up, then $BENCH_RUNS times (default 3) into Spark's ``noop`` sink, the
caches cleared before every sample; the median is reported. Prints one JSON line.
``cold_wall_default_job_sec`` is session start plus the first (cold) run of the file job (lines
written, parsed, detection in two passes), the figure comparable to the reference's 13 to 14 s wall
time of a whole run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sigmawatch.plans.jobs import anomalies_of_readings  # noqa: E402
from sigmawatch.plans.queries import QUERIES  # noqa: E402
from sigmawatch.session import local_session  # noqa: E402

HEADLINE = [
    "anomalies_incremental", "anomalies_two_pass", "anomalies_weekly", "anomalies_by_user",
    "anomalies_sigma2", "anomalies_6h", "window_stats", "merge_stats", "constant_guard",
    "anomaly_lines", "anomalies_grid", "bucketed_archive", "stats_store",
    "readings_parse", "replay_backfill", "stream_anomalies", "stream_window_stats",
]


def file_job(method: str):
    """The reference's file job: JSON lines to anomalies (the events as reading lines)."""
    def run(spark, sf_dir):
        return anomalies_of_readings(QUERIES["readings_parse"](spark, sf_dir), "1 day", 3.0, method)
    return run


EXTRA = {"detect_file_two_pass": file_job("two_pass"), "detect_file_incremental": file_job("incremental")}


def timed(spark, fn, sf_dir: str) -> float:
    spark.catalog.clearCache()
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = set(filter(None, os.environ.get("BENCH_ONLY", "").split(",")))
    t0 = time.perf_counter()
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    startup = time.perf_counter() - t0
    # The reference's figures are whole runs, start-up included: time the default job cold too.
    try:
        cold_default = timed(spark, EXTRA["detect_file_two_pass"], sf_dir)
    except Exception as err:
        print(f"# cold default job: FAILED {type(err).__name__}: {err}", file=sys.stderr)
        cold_default = float("nan")
    todo = {n: QUERIES[n] for n in HEADLINE}
    todo.update(EXTRA)
    if only:
        todo = {n: f for n, f in todo.items() if n in only}
    results, failed = {}, {}
    for name, fn in todo.items():
        try:
            timed(spark, fn, sf_dir)  # warm-up
            samples = [timed(spark, fn, sf_dir) for _ in range(runs)]
        except Exception as err:  # record and go on: one failure must not lose the whole bench
            failed[name] = f"{type(err).__name__}: {str(err)[:200]}"
            print(f"# {name}: FAILED {failed[name]}", file=sys.stderr, flush=True)
            continue
        finally:
            spark.catalog.clearCache()
        results[name] = round(statistics.median(samples), 3)
        print(f"# {name}: {results[name]} s", file=sys.stderr, flush=True)
    sf = sf_dir.rsplit("sf", 1)[-1] if "sf" in os.path.basename(sf_dir) else sf_dir
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": sf,
        "cpus": cpus,
        "runs": runs,
        "session_start_sec": round(startup, 3),
        "cold_default_job_sec": None if cold_default != cold_default else round(cold_default, 3),
        "cold_wall_default_job_sec": (None if cold_default != cold_default
                                      else round(startup + cold_default, 3)),
        "failed": failed,
    }))


if __name__ == "__main__":
    main()
