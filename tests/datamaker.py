"""Synthetic readings generated as a Spark job.

Every value is a pure function of ``(seed, device, window, index)`` through ``xxhash64``, so the
data does not depend on the number of partitions or on which task makes which row, and the
whole data set is ``spark.range`` plus column expressions (whole-stage codegen, no Python).

Model (the reference's): each device has a baseline of 20 +/- 5 C, each reading adds Gaussian
noise with sigma 0.3 C, and with probability ``p`` per device and window one reading (at a
uniform index) is replaced by baseline + 60 C with no noise. Reading ``i`` of window ``w`` is
at ``w * window_ms + i * max(1, window_ms div per_device)`` ms.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sigmawatch.functions.format import device_id

# Fixed values of the reference's generator model.
BASELINE_CENTER_C = 20.0
BASELINE_SPREAD_C = 5.0
NOISE_STDDEV_C = 0.3
SPIKE_OFFSET_C = 60.0
DEFAULT_SEED = 42

READING_COLUMNS = ("deviceId", "temperatureC", "timestampMillis")
ROWS_PER_PARTITION = 8_000_000

_TWO_POW_M53 = 2.0 ** -53
# Salts keep the hash streams of different draws apart.
_S_BASELINE, _S_SPIKE, _S_INDEX, _S_U1, _S_U2 = 1, 2, 3, 4, 5


def check_params(per_device: int, window_ms: int, windows: int, p: float,
                 devices: int | None = None) -> None:
    counts = {"per_device": per_device, "window_ms": window_ms, "windows": windows}
    if devices is not None:
        counts["devices"] = devices
    bad = [k for k, v in counts.items() if int(v) < 1]
    if bad:
        raise ValueError(f"{', '.join(bad)} must be >= 1")
    if not (0.0 <= float(p) <= 1.0) or math.isnan(float(p)):
        raise ValueError("p must be a probability in [0, 1]")


def uniform(seed: int, salt: int, *cols: Column) -> Column:
    """A uniform double in [0, 1) from the top 53 bits of ``xxhash64(seed, salt, cols...)``."""
    h = F.xxhash64(F.lit(int(seed)).cast("long"), F.lit(salt), *cols)
    return F.shiftrightunsigned(h, 11).cast("double") * F.lit(_TWO_POW_M53)


def readings_for(index: DataFrame, per_device: int, window_ms: int, seed: int, p: float) -> DataFrame:
    """Readings from a DataFrame of ``(device long, window long, i long)`` index rows."""
    device, window, i = F.col("device"), F.col("window"), F.col("i")
    baseline = (F.lit(BASELINE_CENTER_C)
                + (uniform(seed, _S_BASELINE, device) * 2 - 1) * F.lit(BASELINE_SPREAD_C))
    spiked = uniform(seed, _S_SPIKE, device, window) < F.lit(float(p))
    spike_index = F.pmod(F.xxhash64(F.lit(int(seed)).cast("long"), F.lit(_S_INDEX), device, window),
                         F.lit(int(per_device)).cast("long"))
    # Box-Muller on two independent uniforms; 1 - u lies in (0, 1], so the log is finite.
    u1 = uniform(seed, _S_U1, device, window, i)
    u2 = uniform(seed, _S_U2, device, window, i)
    gauss = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - u1)) * F.cos(F.lit(2 * math.pi) * u2)
    temperature = (F.when(spiked & (i == spike_index), baseline + F.lit(SPIKE_OFFSET_C))
                   .otherwise(baseline + gauss * F.lit(NOISE_STDDEV_C)))
    step = max(1, int(window_ms) // int(per_device))
    millis = window * F.lit(int(window_ms)) + i * F.lit(step)
    return index.select(device_id(device).alias("deviceId"),
                        temperature.alias("temperatureC"),
                        millis.cast("long").alias("timestampMillis"))


def generate_readings(spark: SparkSession, devices: int, per_device: int, window_ms: int,
                      windows: int = 1, p: float = 0.02, seed: int = DEFAULT_SEED,
                      partitions: int | None = None) -> DataFrame:
    """``devices * windows * per_device`` readings in ``partitions`` tasks.

    By default, at least the cluster's parallelism and at most ``ROWS_PER_PARTITION`` rows per
    task. Row ``r`` of ``spark.range`` decodes to (device, window, i), so every task generates a
    contiguous slice; nothing is collected or shipped from the driver.
    """
    check_params(per_device, window_ms, windows, p, devices)
    total = int(devices) * int(windows) * int(per_device)
    parts = partitions or max(spark.sparkContext.defaultParallelism,
                              -(-total // ROWS_PER_PARTITION))
    per_dev_rows = int(windows) * int(per_device)
    r = F.col("id")
    index = spark.range(0, total, 1, parts).select(
        (r / F.lit(per_dev_rows)).cast("long").alias("device"),
        (F.pmod(r, F.lit(per_dev_rows)) / F.lit(int(per_device))).cast("long").alias("window"),
        F.pmod(r, F.lit(int(per_device))).alias("i"),
    )
    return readings_for(index, per_device, window_ms, seed, p)


def generate_for_devices(device_index: DataFrame, per_device: int, window_ms: int,
                         windows: int = 1, p: float = 0.02, seed: int = DEFAULT_SEED,
                         column: str = "device") -> DataFrame:
    """Readings for the device indices in ``device_index[column]`` (any DataFrame of integers).

    Each device row expands to ``windows * per_device`` rows with two ``explode``s of small
    ranges (sizes set by the parameters), so the work is spread like the device rows are.
    """
    check_params(per_device, window_ms, windows, p)
    index = (device_index.select(F.col(column).cast("long").alias("device"))
             .withColumn("window", F.explode(F.sequence(F.lit(0).cast("long"),
                                                        F.lit(int(windows) - 1).cast("long"))))
             .withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"),
                                                   F.lit(int(per_device) - 1).cast("long")))))
    return readings_for(index, per_device, window_ms, seed, p)
