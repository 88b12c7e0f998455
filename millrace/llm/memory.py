"""Memory of the Python workers: what the work on a batch has freed goes back to the system.

Workers live on between stages, beside the heap of their executor, and the C library and Arrow keep
what is freed for what comes next.  Every function that runs in a worker ends its batches with this,
so that a worker holds what it works on, and an idle one little.  Tables and memos that outlive a batch
are ``kept``, and go when the worker turns to a stage that does not use them.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Hashable, Iterator
from functools import wraps
from typing import TypeVar

import pyarrow as pa
from pyspark import TaskContext

T = TypeVar("T")

_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc alone

#: What the worker remembers by key: the stage that used it last, and the thing.
_KEPT: dict[Hashable, tuple[int | None, object]] = {}


def _stage() -> int | None:
    task = TaskContext.get()
    return task.stageId() if task is not None else None


def kept(key: Hashable, make: Callable[[], T]) -> T:
    """What ``make`` returns, remembered for the worker's further batches and tasks; what only other stages used goes first."""
    if key in _KEPT:
        thing = _KEPT[key][1]
    else:
        forget()
        thing = make()
    _KEPT[key] = _stage(), thing
    return thing


def forget() -> None:
    """Drop what is kept and was not used by the stage that the worker is at."""
    now = _stage()
    for key in [k for k, (stage, _) in _KEPT.items() if stage != now]:
        del _KEPT[key]


def give_back() -> None:
    forget()
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def lean(run: Callable) -> Callable:
    """``run``, a function over batches that keeps nothing, giving back before and after each batch."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch
            del batch
            give_back()

    @wraps(run)
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        yield from run(each(batches))
        give_back()

    return whole


def lean_column(function: Callable) -> Callable:
    """``function``, of Arrow arrays, giving back when it is done."""

    @wraps(function)
    def whole(*columns: pa.Array) -> pa.Array:
        out = function(*columns)
        give_back()
        return out

    return whole
