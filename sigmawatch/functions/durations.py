"""Fixed-length durations as text."""

from __future__ import annotations

import re

_UNIT_MS = {"millisecond": 1, "second": 1000, "minute": 60_000, "hour": 3_600_000,
            "day": 86_400_000, "week": 7 * 86_400_000}


def duration_millis(duration: str) -> int:
    """Milliseconds of a fixed-length window duration such as ``'7 days'`` or ``'1 hour 30 minutes'``."""
    parts = re.findall(r"(\d+)\s*([a-zA-Z]+)", duration)
    if not parts or re.sub(r"(\d+)\s*([a-zA-Z]+)", "", duration).strip():
        raise ValueError(f"unsupported duration {duration!r}")
    total = 0
    for number, unit in parts:
        unit = unit.lower().rstrip("s")
        if unit not in _UNIT_MS:
            raise ValueError(f"unsupported unit {unit!r} in {duration!r}")
        total += int(number) * _UNIT_MS[unit]
    return total
