"""Workers serve one stage after another: what a task no longer needs goes back to the machine."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle

Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def give_back() -> None:
    """Return freed memory of Arrow and of the C library, which would keep it for later tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None
    if trim is not None:
        trim(0)


def tidy(task: Task) -> Task:
    """``task``, with its memory given back at its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            give_back()

    return run


cloudpickle.register_pickle_by_value(sys.modules[__name__])
