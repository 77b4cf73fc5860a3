"""A read-only table from 64-bit keys to numbers, looked up for whole arrays at once."""

import numpy as np

_FREE = np.uint64(0xFFFFFFFFFFFFFFFF)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class HashTable:
    """Open addressing at half load or less. Keys must be distinct; the largest key is taken as its
    predecessor."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.mask = (1 << bits) - 1
        self.keys = np.full(1 << bits, _FREE)
        self.values = np.zeros(1 << bits, values.dtype)
        keys = np.minimum(keys, _FREE - np.uint64(1))
        slot = self._slot(keys)
        while len(keys):
            free = self.keys[slot] == _FREE
            self.keys[slot[free]] = keys[free]  # of several for one slot, the last stays
            placed = self.keys[slot] == keys
            self.values[slot[placed]] = values[placed]
            keys, values, slot = keys[~placed], values[~placed], (slot[~placed] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _SPREAD) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values (0 where absent), and whether the keys are there."""
        keys = np.minimum(keys, _FREE - np.uint64(1))
        slot = self._slot(keys)
        there = self.keys[slot]
        found = there == keys
        open_ = np.flatnonzero(~found & (there != _FREE))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & self.mask
            there = self.keys[slot[open_]]
            hit = there == keys[open_]
            found[open_[hit]] = True
            open_ = open_[~hit & (there != _FREE)]
        return np.where(found, self.values[slot], self.values.dtype.type(0)), found
