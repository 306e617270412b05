"""Memory of Python workers, which Spark uses again for task after task of any operator."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa

_kept: dict[str, Callable[[], None]] = {}
_last = ""


def enter(name: str, forget: Callable[[], None] = lambda: None) -> None:
    """Call this as an operator's task starts: what other operators have kept in this worker goes."""
    global _last
    if _last != name:
        for other in _kept:
            if other != name:
                _kept[other]()
        _kept.clear()
        release()
    _kept[name], _last = forget, name


def release() -> None:
    """Hand freed memory back to the system, as the executor's memory is shared with the JVM."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library, which has no such call


def texts(column: pa.Array, rows: int = 512) -> Iterator[str | None]:
    """A column's texts, of which only some rows are Python strings at a time."""
    for at in range(0, len(column), rows):
        yield from column.slice(at, rows).to_pylist()
