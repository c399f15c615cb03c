"""Minimal perfect hashing of 64-bit keys, level by level: at each level a key whose slot no other key wants sets that
slot's bit, and the others go on to the next level. A key's number is the rank of its bit. About 4 bits a key."""

from __future__ import annotations

import numpy as np

from .kernels import U64, mix

LEVELS, GAMMA = 40, 2


class PerfectHash:
    def __init__(self, keys: np.ndarray):
        """keys: distinct unsigned 64-bit integers."""
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []
        rest, self.size = np.ascontiguousarray(keys, U64), 0
        while len(rest) and len(self.levels) < LEVELS:
            width = max(64, -(-len(rest) * GAMMA // 64) * 64)
            slot = self._slot(rest, len(self.levels), width)
            taken = np.bincount(slot, minlength=width)
            bits = np.packbits(taken == 1, bitorder="little").view(U64)
            ranks = self.size + np.concatenate(([0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)))
            self.levels.append((width, bits, ranks[:-1]))
            self.size, rest = int(ranks[-1]), rest[taken[slot] != 1]
        self.last = np.sort(rest)
        self.size += len(rest)

    @staticmethod
    def _slot(keys: np.ndarray, level: int, width: int) -> np.ndarray:
        return (mix(keys + U64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)) % U64(width)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The numbers of the keys, each below ``size``; a key that isn't of the set gets any such number, or -1."""
        found = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, (width, bits, ranks) in enumerate(self.levels):
            slot = self._slot(keys[open_], level, width)
            word, bit = bits[slot >> 6], (slot & 63).astype(U64)
            hit = (word >> bit) & U64(1) == U64(1)
            below = np.bitwise_count(word & ((U64(1) << bit) - U64(1)))
            found[open_[hit]] = (ranks[slot >> 6] + below)[hit]
            open_ = open_[~hit]
        if len(self.last) and len(open_):
            at = np.minimum(np.searchsorted(self.last, keys[open_]), len(self.last) - 1)
            hit = self.last[at] == keys[open_]
            found[open_[hit]] = (self.size - len(self.last) + at)[hit]
        return found
