"""One place per worker process for the large table an operator works with.

Workers outlive a stage and serve the next operator too, so a table is given up
as soon as another one is asked for: a worker holds one at a time."""

from __future__ import annotations

import ctypes
from collections.abc import Callable

import pyarrow as pa

_HELD: list = [None, None]


def free() -> None:
    """Give up what this process holds, and the memory that its allocators keep."""
    if _HELD[0] is not None:
        _HELD[:] = [None, None]
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def held(key, build: Callable):
    """The object under ``key``, built if this process holds another one."""
    if _HELD[0] != key:
        free()
        _HELD[:] = [key, build()]
    return _HELD[1]
