"""What a Python worker keeps between tasks."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa

Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


#: Rows of a batch that are turned into Python objects at once.
PART_ROWS = 500


def parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut to a bounded number of rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, PART_ROWS):
            yield batch.slice(at, PART_ROWS)


def trim() -> None:
    """Give memory that was freed back to the system; idle workers live on."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trimmed = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trimmed:
        trimmed(0)


def lean(run: Run) -> Run:
    """``run``, which trims the worker's memory when its input has ended."""

    @wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            trim()

    return wrapped
