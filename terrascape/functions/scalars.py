"""Small functions of configurations and files."""

from __future__ import annotations

import math
import re
from typing import Any


def as_list(value: Any) -> list:
    """None: empty; a list or tuple: its items; anything else: alone."""
    if value is None:
        return []
    return list(value) if isinstance(value, (list, tuple)) else [value]


def parse_size(text: str) -> int:
    """Bytes of ``64M``, ``1.5G`` and the like: K, M, G, T are powers of 1024; a bare
    whole number is bytes; anything else is an error."""
    found = re.fullmatch(r"\s*(?:(\d+)|(\d+(?:\.\d*)?|\.\d+)\s*([KMGT]))\s*", str(text), re.IGNORECASE)
    if not found:
        raise ValueError(f"not a size: {text!r}")
    return int(found[1]) if found[1] else int(float(found[2]) * 1024 ** " KMGT".index(found[3].upper()))


def part_count(size: int, chunk: int) -> int:
    """Parts of a file: at least one."""
    return max(1, math.ceil(size / chunk))


def buffer_metres(hours: float) -> float:
    """Distance that no travel of so many hours exceeds (104 km an hour)."""
    return hours * 104 * 1000
