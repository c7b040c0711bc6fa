"""A bounded memory of strings and their token ids, looked up by hash for whole blocks at once."""

from __future__ import annotations

import numpy as np

MOST_STRINGS = 250_000  # beyond either bound the memory starts anew
MOST_IDS = 2_000_000


class IdTable:
    """Open addressing over 64-bit hashes; a found string's number leads to its ids in a pool."""

    def __init__(self):
        self.reset()

    def reset(self) -> None:
        self.size = 1 << 16
        self.keys = np.zeros(self.size, np.uint64)
        self.numbers = np.full(self.size, -1, np.int64)
        self.known = 0
        self.pool = np.zeros(1 << 16, np.uint32)
        self.pool_end = 0
        self.at = np.zeros(1 << 16, np.int64)  # of each string its ids' start, then the next one's

    def full(self) -> bool:
        return self.known > MOST_STRINGS or self.pool_end > MOST_IDS

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The numbers of the hashes (none of them 0), -1 for unknown ones."""
        mask = np.uint64(self.size - 1)
        slot = (hashes >> np.uint64(7)) & mask
        got = self.keys[slot]
        found = np.where(got == hashes, self.numbers[slot], -1)
        todo = np.flatnonzero((got != hashes) & (got != 0))
        while len(todo):
            slot[todo] = (slot[todo] + np.uint64(1)) & mask
            got = self.keys[slot[todo]]
            hit = got == hashes[todo]
            found[todo[hit]] = self.numbers[slot[todo[hit]]]
            todo = todo[~hit & (got != 0)]
        return found

    def learn(self, hashes: np.ndarray, ids: list[list[int]]) -> None:
        """Adds strings that are not known yet."""
        n = len(ids)
        lengths = np.array([len(x) for x in ids], np.int64)
        flat = np.array([i for x in ids for i in x], np.uint32)
        while self.pool_end + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while self.known + n + 1 > len(self.at):
            self.at = np.concatenate([self.at, np.zeros_like(self.at)])
        self.pool[self.pool_end : self.pool_end + len(flat)] = flat
        self.at[self.known + 1 : self.known + n + 1] = self.pool_end + np.cumsum(lengths)
        numbers = np.arange(self.known, self.known + n)
        self.pool_end += len(flat)
        self.known += n
        if 2 * self.known > self.size:
            keys, old = self.keys[self.keys != 0], self.numbers[self.keys != 0]
            while 2 * self.known > self.size:
                self.size *= 4
            self.keys, self.numbers = np.zeros(self.size, np.uint64), np.full(self.size, -1, np.int64)
            self._insert(keys, old)
        self._insert(hashes, numbers)

    def _insert(self, hashes: np.ndarray, numbers: np.ndarray) -> None:
        mask = np.uint64(self.size - 1)
        slot = (hashes >> np.uint64(7)) & mask
        todo = np.arange(len(hashes))
        while len(todo):
            free = todo[self.keys[slot[todo]] == 0]
            self.keys[slot[free]] = hashes[free]  # of several for one slot the last stays
            won = self.keys[slot[todo]] == hashes[todo]
            self.numbers[slot[todo[won]]] = numbers[todo[won]]
            todo = todo[~won]
            slot[todo] = (slot[todo] + np.uint64(1)) & mask

    def ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the numbered strings one after the other, and where each string's ids end."""
        begin = self.at[numbers]
        count = self.at[numbers + 1] - begin
        ends = np.cumsum(count)
        total = int(ends[-1]) if len(ends) else 0
        return self.pool[np.repeat(begin - (ends - count), count) + np.arange(total)], ends
