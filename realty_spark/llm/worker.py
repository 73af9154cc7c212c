"""Memory of Python workers, which outlive their tasks and serve several operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa

from realty_spark.llm import words


def tidy() -> None:
    """Empty the word cache and give freed memory back to the system, for the executor's limit counts all workers."""
    words.forget()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidied(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function over a task's batches that leaves the worker tidy."""
    def task(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            tidy()
    return task
