"""Memory of Python workers, which Spark keeps from task to task."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa

Batches = Iterator[pa.RecordBatch]


def tidy(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """`run`, giving the memory that Arrow holds back to the system when a task ends."""

    @wraps(run)
    def kept_small(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return kept_small
