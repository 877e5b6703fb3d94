"""Memory of Python workers, which stay and serve many tasks.

Two workers stand beside an executor's heap, and what one has freed it keeps for itself: later
steps, also those that need no worker, run beside the most that earlier ones took.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa

# Rows that are worked on and handed back at once.
ROWS = 500

Step = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def give_back() -> None:
    """Return freed memory to the system, as far as the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def released(step: Step) -> Step:
    """The step of a task, after which its worker gives back the memory that it has freed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from step(batches)
        finally:
            give_back()

    return run


def parts(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in order, so many at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
