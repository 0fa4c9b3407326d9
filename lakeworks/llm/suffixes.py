"""Suffix arrays of whole numbers by prefix doubling."""

from __future__ import annotations

import numpy as np


class Suffixes:
    """Suffix array by prefix doubling, with the ranks by prefixes of 1, 2, 4 ... numbers.

    A rank is the first place of all suffixes with the same prefix, so it also begins their interval. Only suffixes
    that still share a prefix are sorted again.
    """

    def __init__(self, numbers: np.ndarray) -> None:
        n = len(numbers)
        self.order = np.argsort(numbers, kind="stable")
        rank = np.empty(n, dtype=np.int64)
        open_slots = self._settle(rank, numbers[self.order], self.order, np.arange(n))
        self.ranks, step = [rank], 1
        while len(open_slots):
            rank = rank.copy()
            at = self.order[open_slots]
            ahead = np.where(at + step < n, self.ranks[-1][np.minimum(at + step, n - 1)] + 1, 0)
            key = rank[at] * (n + 1) + ahead
            again = np.argsort(key, kind="stable")
            self.order[open_slots] = at[again]
            open_slots = self._settle(rank, key[again], at[again], open_slots)
            self.ranks.append(rank)
            step *= 2

    @staticmethod
    def _settle(rank: np.ndarray, keys: np.ndarray, at: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """Set the ranks of sorted suffixes; the slots of those that share theirs."""
        if not len(keys):
            return slots
        fresh = np.r_[True, keys[1:] != keys[:-1]]
        group = np.cumsum(fresh) - 1
        first = slots[np.flatnonzero(fresh)]
        rank[at] = first[group]
        return slots[np.bincount(group)[group] > 1]

    def sizes(self, level: int) -> np.ndarray:
        """Rows of the interval that begins at each rank of a level."""
        return np.bincount(self.ranks[level], minlength=len(self.order))

    def ahead(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many numbers from ``a`` and from ``b`` on are alike."""
        n, moved = len(self.order), np.zeros(len(a), dtype=np.int64)
        for level in range(len(self.ranks) - 1, -1, -1):
            x, y = a + moved, b + moved
            inside = (x < n) & (y < n)
            rank = self.ranks[level]
            same = inside & (rank[np.minimum(x, n - 1)] == rank[np.minimum(y, n - 1)])
            moved += same * (1 << level)
        return moved

    def behind(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many numbers before ``a`` and before ``b`` are alike (``a`` < ``b``)."""
        moved = np.zeros(len(a), dtype=np.int64)
        for level in range(len(self.ranks) - 1, -1, -1):
            x, y = a - moved - (1 << level), b - moved - (1 << level)
            rank = self.ranks[level]
            same = (x >= 0) & (rank[np.maximum(x, 0)] == rank[np.maximum(y, 0)])
            moved += same * (1 << level)
        return moved

    def elsewhere(self) -> np.ndarray:
        """For each place, how many numbers from it on stand anywhere else too: the nearer of its two neighbours."""
        out = np.zeros(len(self.order), dtype=np.int64)
        if len(self.order) > 1:
            alike = self.ahead(self.order[:-1], self.order[1:])
            out[self.order] = np.maximum(np.r_[0, alike], np.r_[alike, 0])
        return out
