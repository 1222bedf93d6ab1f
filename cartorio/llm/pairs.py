"""Tables of mergeable symbol pairs, and a memory of what slices have already come to."""

from __future__ import annotations

import numpy as np

from cartorio.llm.ragged import same_slices, taken

NONE = np.int64(1) << 30  # the rank of a pair that doesn't merge


class PairTable:
    """Rank and merged symbol of pairs, looked up for whole arrays by open addressing."""

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]]) -> None:
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(pairs)) * 4))))
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NONE, np.int64)
        self.merged = np.zeros(1 << self.bits, np.int64)
        wanted = np.array([left << 32 | right for left, right in pairs], np.int64)
        values = np.array(list(pairs.values()), np.int64).reshape(-1, 2)
        slots = self._slots(wanted)
        left = np.arange(len(wanted))
        while len(left):  # those that meet in one slot: the first takes it, the others go on
            free = left[self.keys[slots[left]] < 0]
            _, first = np.unique(slots[free], return_index=True)
            won = free[first]
            at = slots[won]
            self.keys[at], self.ranks[at], self.merged[at] = wanted[won], values[won, 0], values[won, 1]
            left = np.setdiff1d(left, won, assume_unique=True)
            slots[left] = (slots[left] + 1) & (len(self.keys) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The slot of each pair; one whose rank is ``NONE`` for pairs that don't merge."""
        keys = left << 32 | right
        slots = self._slots(keys)
        open_ = np.flatnonzero((self.keys[slots] != keys) & (self.keys[slots] >= 0))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & (len(self.keys) - 1)
            there = self.keys[slots[open_]]
            open_ = open_[(there != keys[open_]) & (there >= 0)]
        return slots


class Memo:
    """Runs of numbers by slice: a 64-bit key finds a slice, its bytes tell that it is the one.

    Of several slices with one key the first is kept. The memory starts again from its seed once it holds
    ``limit`` keys: that bounds a task's memory only, a forgotten slice is worked out again.
    """

    def __init__(
        self, keys: np.ndarray, runs: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
        limit: int = 1 << 19,
    ) -> None:
        self.limit, self.seed = limit, (keys, runs, np.ones(len(keys), np.int64), data, starts, ends)
        self._restart()

    def _restart(self) -> None:
        self.keys, self.pool, self.bytes = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint8)
        self.starts, self.lengths, self.begins, self.ends = (np.zeros(0, np.int64) for _ in range(4))
        self.add(*self.seed)

    def add(
        self, keys: np.ndarray, runs: np.ndarray, lengths: np.ndarray,
        data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
    ) -> None:
        if len(self.keys) > len(self.seed[0]) and len(self.keys) + len(keys) > self.limit:
            self._restart()
        size = ends - starts
        begins = len(self.bytes) + np.cumsum(size) - size
        at = len(self.pool) + np.cumsum(lengths) - lengths
        self.pool = np.concatenate([self.pool, runs])
        self.bytes = np.concatenate([self.bytes, taken(data, starts, size)])
        all_keys = np.concatenate([self.keys, keys])
        order = np.argsort(all_keys, kind="stable")
        self.keys = all_keys[order]
        self.starts = np.concatenate([self.starts, at])[order]
        self.lengths = np.concatenate([self.lengths, lengths])[order]
        self.begins = np.concatenate([self.begins, begins])[order]
        self.ends = np.concatenate([self.ends, begins + size])[order]

    def places(
        self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Where each slice would be, and whether it is there."""
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        known = (self.keys[at] == keys) if len(self.keys) else np.zeros(len(keys), bool)
        rows = np.flatnonzero(known)
        known[rows] = same_slices(
            data, starts[rows], ends[rows], self.bytes, self.begins[at[rows]], self.ends[at[rows]]
        )
        return at, known
