"""Batch operators: window statistics, detection shapes, statistics merge, stats attach."""

from .attach import attach_stats, measure
from .detect import METHODS, detect, flag, flag_counts, group_stats
from .grid import detect_grid
from .merge import merge_parts, merge_stats
from .windows import assign_windows, window_stats

__all__ = ["METHODS", "assign_windows", "attach_stats", "detect", "detect_grid", "flag", "flag_counts",
           "group_stats", "measure", "merge_parts", "merge_stats", "window_stats"]
