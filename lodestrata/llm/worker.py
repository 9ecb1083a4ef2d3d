"""What a Python worker of Spark keeps from task to task.

Spark hands a worker from task to task, of whatever operator. What one operator keeps there would stay beside all
that the next ones need, so their tasks let go of it first.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Hashable
from contextlib import suppress
from typing import TypeVar

import pyarrow as pa

Kept = TypeVar("Kept")
_kept: dict[Hashable, object] = {}


def kept(key: Hashable, make: Callable[[], Kept]) -> Kept:
    """What ``make`` gave when this worker asked for ``key`` first; nothing else is kept beside it."""
    if key not in _kept:
        let_go()
        _kept[key] = make()
    return _kept[key]


def let_go() -> None:
    """Drop what is kept, and hand memory that is not in use back to the system."""
    _kept.clear()
    pa.default_memory_pool().release_unused()
    with suppress(AttributeError, OSError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)
