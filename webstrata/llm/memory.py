"""Memory of Python workers, which live on after their tasks and serve stages of other kinds."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa

_forget: list[Callable[[], None]] = []


def forgotten_after_tasks(function: Callable[[], None]) -> Callable[[], None]:
    """Marks a function that drops what a module keeps between batches."""
    _forget.append(function)
    return function


def give_back() -> None:
    """Drop what modules keep, and return free memory to the system as far as the allocators can."""
    for function in _forget:
        function()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function for ``mapInArrow`` whose worker gives memory back when the task ends, in whatever way."""

    @wraps(run)
    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped
