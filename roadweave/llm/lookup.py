"""Many numbers looked up at once, by open addressing in arrays."""

from __future__ import annotations

import numpy as np

_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def home(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where in a table of 2**bits places a key's search begins."""
    mixed = keys * _SPREAD
    return ((mixed ^ (mixed >> np.uint64(29))) * _MIX >> np.uint64(64 - bits)).astype(np.int64)


class Lookup:
    """Row of each of some distinct numbers."""

    def __init__(self, keys: np.ndarray) -> None:
        self.bits = max(8, int(np.ceil(np.log2(max(1, len(keys)) * 3))))
        self.mask = (1 << self.bits) - 1
        self.keys = np.zeros(1 << self.bits, dtype=np.uint64)
        self.rows = np.full(1 << self.bits, -1, dtype=np.int32)
        left = np.arange(len(keys))
        at = home(keys, self.bits)
        while len(left):
            free = np.flatnonzero(self.rows[at] < 0)
            spot, first = np.unique(at[free], return_index=True)
            won = free[first]
            self.rows[spot], self.keys[spot] = left[won], keys[left[won]]
            stay = np.ones(len(left), dtype=bool)
            stay[won] = False
            left, at = left[stay], (at[stay] + 1) & self.mask

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Rows of the keys, -1 where there is none."""
        at = home(keys, self.bits)
        out = self.rows[at]
        other = np.flatnonzero((out >= 0) & (self.keys[at] != keys))
        at = at[other]
        while len(other):
            at = (at + 1) & self.mask
            row = self.rows[at]
            out[other] = row
            more = (row >= 0) & (self.keys[at] != keys[other])
            other, at = other[more], at[more]
        return out
