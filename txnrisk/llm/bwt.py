"""Burrows-Wheeler transforms of byte strings over blocks, and their merge.

A suffix is read in symbols of ``block`` bytes: the suffix at p is the blocks
at p, p + block, ... to the end of its string. So the transform of a position
is the block before it (at p - block), a string of n bytes is ``block``
interleaved strings of blocks, and ``depth`` symbols cover depth * block bytes.

``shard_bwt`` sorts one shard's suffixes. ``merge`` interleaves any number of
shards without comparing suffixes again: starting from the shards laid end to
end, each refinement deals the interleave by the transform's symbols with a
stable counting sort, which orders it by one symbol more (an LF step for all
suffixes at once). A border that appears in step h separates suffixes with
h - 1 common symbols; borders never vanish. After ``depth`` steps the
stretches between borders are the intervals of suffixes that have depth * block
bytes in common."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_END = np.uint32(0)


@dataclass
class ShardBwt:
    position: np.ndarray  # of each suffix, in order; -1 for an end
    before: np.ndarray  # symbol before it; 0 if there is none
    depth: int


def by_symbol(symbol: np.ndarray) -> np.ndarray:
    """Stable order of 32-bit symbols by two counting passes of 16 bits."""
    order = np.argsort((symbol & np.uint32(0xFFFF)).astype(np.uint16), kind="stable")
    high = (symbol >> np.uint32(16)).astype(np.uint16)
    return order if not high.any() else order[np.argsort(high[order], kind="stable")]


def shard_bwt(symbol: np.ndarray, start: np.ndarray, end: np.ndarray, block: int, depth: int) -> ShardBwt:
    """``symbol`` (from 1 on) of the block at each position; the strings are the
    positions [start, end) that have a whole block."""
    inside = np.zeros(len(symbol) + 1, dtype=np.int32)
    np.add.at(inside, start, 1)
    np.add.at(inside, end, -1)
    live = np.cumsum(inside[:-1]) > 0
    string_end = np.repeat(end, end - start)
    at = np.flatnonzero(live)
    order = np.arange(len(at))
    for h in reversed(range(depth)):  # least significant symbol first
        p = at[order] + h * block
        there = p < string_end[order]
        key = np.zeros(len(order), dtype=np.uint32)
        key[there] = symbol[p[there]]
        order = order[by_symbol(key)]
    string_start = np.repeat(start, end - start)
    last = at + block >= string_end  # an end follows
    position = np.concatenate((np.full(int(last.sum()), -1, dtype=np.int64), at[order]))
    before = np.zeros(len(position), dtype=np.uint32)
    n = int(last.sum())
    before[:n] = symbol[at[last]]
    q = at[order] - block
    has = q >= string_start[order]
    before[n:][has] = symbol[q[has]]
    return ShardBwt(position, before, depth)


def merge(shards: list[ShardBwt]) -> tuple[np.ndarray, np.ndarray]:
    """(position, common): all suffixes in merged order, and how many symbols
    each has in common with the one before it, ``depth`` at most."""
    depth = shards[0].depth
    z = np.repeat(np.arange(len(shards), dtype=np.uint16), [len(s.position) for s in shards])
    ends = np.repeat(np.arange(len(shards), dtype=np.uint16), [int((s.position < 0).sum()) for s in shards])
    before = np.concatenate([s.before for s in shards])
    part = np.zeros(len(z), dtype=np.int64)  # stretch of equal prefixes
    common = np.full(len(z), depth, dtype=np.int16)

    def rows(z: np.ndarray) -> np.ndarray:
        """Index into the shards laid end to end: the i-th of shard b in z is b's i-th suffix."""
        out = np.empty(len(z), dtype=np.int64)
        order = np.argsort(z, kind="stable")
        out[order] = np.arange(len(z))  # shards laid end to end are in this order
        return out

    for h in range(1, depth + 1):
        c = before[rows(z)]
        use = np.flatnonzero(c != _END)
        order = use[by_symbol(c[use])]
        symbol, old = c[order], part[order]
        border = np.ones(len(order), dtype=bool)
        border[1:] = (symbol[1:] != symbol[:-1]) | (old[1:] != old[:-1])
        z = np.concatenate((ends, z[order]))
        new = np.zeros(len(z), dtype=bool)
        new[0] = True
        new[len(ends):] = border
        common[new & (common == depth)] = h - 1
        part = np.cumsum(new)
    return np.concatenate([s.position for s in shards])[rows(z)], common
