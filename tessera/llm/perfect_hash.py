"""Minimal perfect hash over 64-bit keys: levels of bitmaps, then ranks."""

from __future__ import annotations

import numpy as np

#: Bits of a level for each key that reaches it.
SPREAD = 2
#: Levels before the keys that still collide are listed outright.
LEVELS = 40
_U = np.uint64


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser of xor-shifts and multiplications, for a whole array."""
    with np.errstate(over="ignore"):
        x = keys.astype(_U) + _U((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def stamps(keys: np.ndarray) -> np.ndarray:
    """The stored 32-bit fingerprint of each key; independent of its levels."""
    return (mix(keys, 1000) >> _U(32)).astype(np.uint32)


class PerfectHash:
    """slot(keys): 0..n-1, each once, for the n distinct keys it was built from."""

    def __init__(self, sizes: list[int], bits: list[np.ndarray], rest: np.ndarray):
        self.sizes, self.bits, self.rest = sizes, bits, rest
        counts = [np.bitwise_count(b).astype(np.int64) for b in bits]
        self.ranks, base = [], 0
        for c in counts:
            self.ranks.append(base + np.concatenate([[0], np.cumsum(c)]))
            base = int(self.ranks[-1][-1])
        self.base = base

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        left, sizes, bits = keys.astype(_U), [], []
        while len(left) and len(sizes) < LEVELS:
            size = -(-len(left) * SPREAD // 64) * 64
            at = mix(left, len(sizes)) % _U(size)
            hits = np.bincount(at.astype(np.int64), minlength=size)
            bits.append(np.packbits(hits == 1, bitorder="little").view("<u8"))
            sizes.append(size)
            left = left[hits[at.astype(np.int64)] != 1]
        return cls(sizes, bits, np.sort(left))

    def slot(self, keys: np.ndarray) -> np.ndarray:
        """-1 for a key that is surely absent; an absent key may also get a slot."""
        keys = keys.astype(_U)
        out = np.full(len(keys), -1, dtype=np.int64)
        todo = np.arange(len(keys))
        for level, (size, bits, ranks) in enumerate(zip(self.sizes, self.bits, self.ranks, strict=True)):
            at = mix(keys[todo], level) % _U(size)
            word, bit = (at // _U(64)).astype(np.int64), at % _U(64)
            hit = (bits[word] >> bit) & _U(1) == 1
            w = word[hit]
            below = bits[w] & ((_U(1) << bit[hit]) - _U(1))
            out[todo[hit]] = ranks[w] + np.bitwise_count(below)
            todo = todo[~hit]
            if not len(todo):
                return out
        if len(self.rest):
            k = np.searchsorted(self.rest, keys[todo]).clip(max=len(self.rest) - 1)
            found = self.rest[k] == keys[todo]
            out[todo[found]] = self.base + k[found]
        return out

    def arrays(self) -> list[np.ndarray]:
        return [np.array(self.sizes, dtype="<u8"), np.concatenate(self.bits) if self.bits else np.zeros(0, "<u8"), self.rest.astype("<u8")]

    @classmethod
    def of(cls, sizes: np.ndarray, bits: np.ndarray, rest: np.ndarray) -> PerfectHash:
        ends = np.cumsum(sizes.astype(np.int64) // 64)
        return cls([int(x) for x in sizes], np.split(bits, ends[:-1]) if len(ends) else [], rest)
