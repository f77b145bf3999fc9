"""Tables of distinct chunks: each worker segments a chunk once and joins the result back by position."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import Any

#: Entries that a worker keeps; beyond, it starts afresh. This bounds memory only: results don't depend on it.
TABLE_ROWS = 300_000


_filled: ChunkTable | None = None


def release(but: ChunkTable | None = None) -> None:
    """Empties the table that this worker filled last: the worker outlives the operator that needed it."""
    global _filled
    if _filled is not None and _filled is not but:
        _filled.clear()
    _filled = but


class ChunkTable(dict):
    """chunk -> result, filled for many new chunks at a time."""

    def __init__(self, segment: Callable[[list[str]], Iterable[Any]], limit: int = TABLE_ROWS):
        super().__init__()
        self.segment, self.limit = segment, limit

    def fill(self, parts: Iterable[Iterable[str]]) -> None:
        """Segments those chunks of all parts that aren't in the table yet."""
        release(self)
        own = set().union(*parts)
        new = list(own.difference(self))
        if new:
            if len(self) + len(new) > self.limit:
                self.clear()
                new = list(own)
            self.update(zip(new, self.segment(new), strict=True))
