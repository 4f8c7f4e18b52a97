"""Structured Streaming operators."""

from .bounded import run_to_end, with_clock
from .detect_stream import (
    DEFAULT_DELAY, DEFAULT_SALT, detect_stream, rows_dropped_by_watermark, start_to_console,
    start_to_files, start_to_lines, window_stats_stream,
)
from .late import LateRowCounter, counting_late_rows
from .open_windows import open_windows
from .timers import detect_with_timers

__all__ = ["DEFAULT_DELAY", "DEFAULT_SALT", "LateRowCounter", "counting_late_rows", "detect_stream",
           "detect_with_timers", "open_windows", "rows_dropped_by_watermark", "run_to_end",
           "start_to_console", "start_to_files", "start_to_lines", "window_stats_stream", "with_clock"]
