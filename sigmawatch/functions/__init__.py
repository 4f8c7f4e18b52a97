"""Column-level building blocks (built-in Spark expressions only)."""

from .format import DEVICE_ID_FORMAT, LINE_FORMAT, anomaly_line, device_id, epoch_millis
from .stats import (
    DEFAULT_K, HI, LO, M2, MEAN, MIN_READINGS, N, RESERVED, STDDEV, WINDOW_END, WINDOW_START,
    deviates, group_can_flag, is_outlier, merged_moments, moment_aggs, tumbling_window,
)

__all__ = [
    "DEFAULT_K", "DEVICE_ID_FORMAT", "HI", "LINE_FORMAT", "LO", "M2", "MEAN", "MIN_READINGS", "N",
    "RESERVED", "STDDEV", "WINDOW_END", "WINDOW_START", "anomaly_line", "deviates", "device_id",
    "epoch_millis", "group_can_flag", "is_outlier", "merged_moments", "moment_aggs",
    "tumbling_window",
]
