"""Memory of Python workers, which live as long as their executor."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import cache


@cache
def _trim():
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return freed memory to the system, where the C library can; a worker keeps it for its next task otherwise."""
    if _trim():
        _trim()(0)


def tidied(parts: Iterator) -> Iterator:
    """The parts; what making them took is given back after each and at the end."""
    for part in parts:
        yield part
        del part
        give_back()
    give_back()
