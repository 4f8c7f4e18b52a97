"""Reading sources: JSON-lines files and table mappings."""

from .readings import (
    READING_COLUMNS, READING_SCHEMA, malformed_lines, numbered_lines, parse_lines, read_jsonl,
    read_jsonl_stream, to_readings, with_event_time, write_jsonl,
)

__all__ = ["READING_COLUMNS", "READING_SCHEMA", "malformed_lines", "numbered_lines", "parse_lines",
           "read_jsonl", "read_jsonl_stream", "to_readings", "with_event_time", "write_jsonl"]
