"""sigmawatch: per-key, per-window k-sigma outlier detection on Spark (batch and streaming)."""

from .operators import attach_stats, detect, flag_counts, merge_stats, window_stats
from .sinks import print_lines, with_lines, write_lines
from .sources import (
    read_jsonl, read_jsonl_stream,
    to_readings, write_jsonl,
)
from .streaming import detect_stream, window_stats_stream

__all__ = [
    "attach_stats", "detect", "detect_stream", "flag_counts", "merge_stats", "print_lines", "read_jsonl",
    "read_jsonl_stream", "to_readings", "window_stats", "window_stats_stream", "with_lines",
    "write_jsonl", "write_lines",
]
