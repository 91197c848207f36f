"""Minimal perfect hashing of integer keys, vectorised.

A cascade of bit arrays: each level gives a key a place by a hash of its own;
keys alone at their place set its bit and are done, the others go on to the
next level. The index of a key is the number of bits set before its own, so
``n`` keys get exactly the indices 0 to n - 1 at some three bits a key. A key
outside the set gets no index or another key's, so callers keep the keys in
index order and verify.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SPREAD = 2  # places per key and level


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mix of ``keys`` (the finaliser of splitmix64)."""
    x = keys.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _place(keys: np.ndarray, level: int, places: int) -> np.ndarray:
    return (mixed(keys, level) % np.uint64(places)).astype(np.int64)


class PerfectHash:
    """``levels``: for each level which of its places hold a key."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.before = []
        total = 0
        for bits in levels:
            self.before.append(total + np.cumsum(bits) - bits)
            total += int(bits.sum())
        self.n = total

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        """For distinct keys."""
        levels, left = [], keys
        while len(left):
            places = max(64, SPREAD * len(left))
            at = _place(left, len(levels), places)
            held = np.bincount(at, minlength=places)
            levels.append(held == 1)
            left = left[held[at] > 1]
            if len(levels) > 200:
                raise ValueError("keys repeat")
        return cls(levels)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Indices; -1 for keys that no level holds."""
        out = np.full(len(keys), -1, dtype=np.int64)
        open_ = np.arange(len(keys))
        for level, (bits, before) in enumerate(zip(self.levels, self.before, strict=True)):
            at = _place(keys[open_], level, len(bits))
            here = bits[at]
            out[open_[here]] = before[at[here]]
            open_ = open_[~here]
        return out

    def dump(self) -> bytes:
        sizes = np.array([len(self.levels), *map(len, self.levels)], dtype="<i8")
        return sizes.tobytes() + b"".join(np.packbits(b).tobytes() for b in self.levels)

    @classmethod
    def load(cls, data: bytes) -> PerfectHash:
        n = int(np.frombuffer(data, "<i8", 1)[0])
        sizes = np.frombuffer(data, "<i8", n, 8)

        def arrays() -> Iterator[np.ndarray]:
            at = 8 * (n + 1)
            for size in sizes.tolist():
                packed = np.frombuffer(data, np.uint8, (size + 7) // 8, at)
                at += len(packed)
                yield np.unpackbits(packed, count=size).astype(bool)
        return cls(list(arrays()))
