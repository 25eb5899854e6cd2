"""Giving memory back: workers live on between tasks, and what Arrow and the C library keep for later counts against their executor."""

from __future__ import annotations

import ctypes
import ctypes.util
from collections.abc import Callable, Iterator

import pyarrow as pa

_trim = getattr(ctypes.CDLL(ctypes.util.find_library("c") or None), "malloc_trim", None)


def settle() -> None:
    """Returns unused memory to the system."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def settling(run: Callable) -> Callable:
    """run (for mapInArrow) with unused memory given back behind each batch that it yields and at the task's end."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in run(batches):
                yield batch
                del batch
                settle()
        finally:
            settle()

    return whole
