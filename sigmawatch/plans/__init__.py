"""End-to-end plans: archive/replay, the reference's jobs, the registered queries."""

from .archive import archive_readings, archive_stream, duration_millis, replay
from .jobs import detect_file

__all__ = ["archive_readings", "archive_stream", "detect_file", 
           "duration_millis", "replay"]
