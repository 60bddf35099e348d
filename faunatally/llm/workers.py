"""Memory of Python workers."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import wraps

import pandas as pd
import pyarrow as pa

Batches = Iterator[pd.DataFrame]


def give_back() -> None:
    """Return freed memory to the system. A worker serves one task after another and would keep the most any of them took."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not the C library that has it
        pass


def giving_back(task: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """A function for ``mapInPandas`` that gives its memory back before its first batch and after its last."""

    @wraps(task)
    def run(batches: Batches) -> Batches:
        give_back()
        yield from task(batches)
        give_back()

    return run
