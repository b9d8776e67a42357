"""What a Python worker keeps between tasks, and how it gives memory back."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Hashable
from typing import Any

import pyarrow as pa

_tables: dict[Hashable, Any] = {}


def table(key: Hashable, make: Callable[[], Any]) -> Any:
    """A table that tasks of one operator share in a worker; a worker keeps one at a time."""
    if key not in _tables:
        _tables.clear()
        _tables[key] = make()
    return _tables[key]


def give_back() -> None:
    """Let go of kept tables and of memory that earlier tasks have freed.

    Workers serve one task after the other; without this, each holds the most that any needed.
    """
    _tables.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library has no such call
        pass
