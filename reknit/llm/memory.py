"""Memory that a Python worker gives back between tasks."""

from __future__ import annotations

import ctypes

import pyarrow as pa

_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return what is free to the system: workers wait for their next task with all they had."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)
