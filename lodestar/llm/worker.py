"""Tables that a Python worker keeps from task to task: those of one operator at a time.

Workers are reused by the stages of a job and by later jobs. What one operator has learnt of pieces and segments is of no use to
the next, and an executor holds it for each of its workers.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Hashable
from typing import Any

import pyarrow as pa

_KEPT: dict[Hashable, Any] = {}


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """What ``make`` gave when this key was last asked for, unless another operator has been at work since."""
    if key not in _KEPT:
        let_go()
        _give_back()
        _KEPT[key] = make()
    return _KEPT[key]


def let_go() -> None:
    """Called by operators that keep nothing themselves."""
    _KEPT.clear()


def _give_back() -> None:
    """Memory that earlier stages have freed, and the allocators still hold, goes back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)
