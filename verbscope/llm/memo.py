"""A per-worker memo of strings and what was made of them, bounded in bytes."""

from __future__ import annotations

from collections.abc import Callable

#: Bytes that one generation of a memo may take, with what Python needs for each entry.
MEMO_BYTES = 64 << 20
ENTRY_BYTES = 220


class Memo(dict):
    """word -> value, made by ``make(word)`` when missing. When the entries would take more than
    ``limit`` bytes they become the old generation and the former old ones are forgotten; words
    still in use come back. So a worker holds twice ``limit`` at most, whatever the texts."""

    def __init__(self, make: Callable[[str], object], limit: int = MEMO_BYTES):
        self.make, self.limit, self.old, self.held = make, limit, {}, 0

    def __missing__(self, word: str) -> object:
        value = self.old.get(word)
        if value is None:
            value = self.make(word)
        size = ENTRY_BYTES + len(word) + (len(value) if isinstance(value, bytes) else 0)
        if 64 * size > self.limit:
            return value  # too long to be worth its room
        if self.held + size > self.limit:
            self.old, self.held = dict(self), 0
            self.clear()
        self.held += size
        self[word] = value
        return value
