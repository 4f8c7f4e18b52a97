"""Sinks for anomaly rows."""

from .lines import (
    LINE, console_batch_writer, line_batch_writer, print_lines, read_lines, with_lines, write_lines,
)

__all__ = ["LINE", "console_batch_writer", "line_batch_writer", "print_lines", "read_lines", "with_lines",
           "write_lines"]
