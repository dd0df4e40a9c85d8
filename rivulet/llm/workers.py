"""Memory of Python workers, which Spark keeps for later tasks and stages."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa

Batches = Callable[[Iterator], Iterator]


def tidy(batches: Batches, *caches: Callable) -> Batches:
    """``batches``, which at the end of each task gives back what Arrow holds in reserve.

    ``caches`` are cached functions whose results end with the task.
    """

    @wraps(batches)
    def run(parts: Iterator) -> Iterator:
        try:
            yield from batches(parts)
        finally:
            for cached in caches:
                cached.cache_clear()
            pa.default_memory_pool().release_unused()

    return run
