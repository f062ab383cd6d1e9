"""Memory of Python workers, which Spark keeps between tasks and stages."""

from __future__ import annotations

import ctypes
from functools import lru_cache

import pyarrow as pa


@lru_cache(maxsize=1)
def _trim():
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):  # another C library
        return None


def give_back() -> None:
    """Returns memory that is no longer used to the system, so a kept worker does not hold the most that
    any of its batches needed."""
    pa.default_memory_pool().release_unused()
    trim = _trim()
    if trim:
        trim(0)
