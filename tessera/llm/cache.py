"""Bounded caches for use inside tasks, and the memory of Python workers between them."""

from __future__ import annotations

import ctypes
from collections.abc import Callable

import pyarrow as pa

_KEPT: dict[str, Callable[[], None]] = {}


def trim() -> None:
    """Gives memory that is free back to the system; workers live on from stage to stage and would keep it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # not every system has it
        pass


def begin(owner: str, clear: Callable[[], None]) -> None:
    """To be called where a task of an operator begins: what other operators keep in this worker is cleared, and `clear`
    will clear what this one keeps."""
    for name in [n for n in _KEPT if n != owner]:
        _KEPT.pop(name)()
    _KEPT[owner] = clear
    trim()


class TwoGenerations(dict):
    """A dict of at most about 2 * `size` entries: a full generation replaces the one before, used entries return."""

    def __init__(self, size: int):
        super().__init__()
        self.size, self.before = size, {}

    def recall(self, key):
        """The value of a key that the present generation lacks, or None."""
        value = self.before.get(key)
        if value is not None:
            self.keep(key, value)
        return value

    def keep(self, key, value) -> None:
        if len(self) >= self.size:
            self.before = dict(self)
            self.clear()
        self[key] = value
