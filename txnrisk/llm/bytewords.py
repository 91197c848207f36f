"""Words, lines and shingles of whole texts, vectorised over UTF-8 bytes.

Texts are laid end to end in chunks of bounded size, with a line break
between; positions and 64-bit hashes of words come from a few passes over the
bytes. White space is the ASCII set of the contracts (0x20, 0x09-0x0D), so it
never lies inside a multi-byte character."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np

CHUNK_BYTES = 500_000
_BASE = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_POWERS: dict[str, np.ndarray] = {}


def give_back() -> None:
    """Return freed memory to the system. Python workers live on after a task,
    beside an executor whose heap needs the room."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim:
        trim(0)


def mix(h: np.ndarray) -> np.ndarray:
    """Scatter the bits of 64-bit hashes (a bijection)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        n = max(n, CHUNK_BYTES + 1)
        inverse = pow(_BASE, -1, 1 << 64)
        for key, b in (("up", _BASE), ("down", inverse)):
            x = np.full(n, b, dtype=np.uint64)
            x[0] = 1
            _POWERS[key] = np.cumprod(x, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


class Hasher:
    """64-bit hashes of any stretches of ``buf`` from one running sum."""

    def __init__(self, buf: np.ndarray):
        self.up, self.down = _powers(len(buf) + 1)
        total = np.empty(len(buf) + 1, dtype=np.uint64)
        total[0] = 0
        np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * self.up[:len(buf)], out=total[1:])
        self.total = total

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.total[end] - self.total[start]) * self.down[start])


@dataclass
class Chunk:
    """Documents ``first .. first + n - 1`` of the input."""

    first: int
    buf: np.ndarray
    doc_start: np.ndarray
    doc_end: np.ndarray
    word_start: np.ndarray
    word_end: np.ndarray
    word_doc: np.ndarray

    @property
    def n(self) -> int:
        return len(self.doc_start)

    def per_doc(self, doc: np.ndarray) -> np.ndarray:
        return np.bincount(doc, minlength=self.n).astype(np.int64)


def _chunk(first: int, parts: list[bytes], lower: bool) -> Chunk:
    buf = np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)
    if lower:
        buf = _LOWER[buf]
    size = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    end = np.cumsum(size + 1) - 1
    start = end - size
    space = _SPACE[buf]
    edge = np.flatnonzero(np.diff(space, prepend=True))
    word_start, word_end = edge[::2], edge[1::2]
    return Chunk(first, buf, start, end, word_start, word_end,
                 np.searchsorted(end, word_start, side="right"))


def chunks(texts: Iterable[str | None], lower: bool = False) -> Iterator[Chunk]:
    """Chunks in input order; a null text counts as empty."""
    parts: list[bytes] = []
    held = first = k = 0
    for k, text in enumerate(texts, 1):
        part = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""
        parts.append(part)
        held += len(part) + 1
        if held >= CHUNK_BYTES:
            yield _chunk(first, parts, lower)
            parts, held, first = [], 0, k
    if parts:
        yield _chunk(first, parts, lower)


def ngrams(word_hash: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each word on (of the first len - n + 1)."""
    count = max(0, len(word_hash) - n + 1)
    out = np.zeros(count, dtype=np.uint64)
    for j in range(n):
        out = out * np.uint64(_BASE) + word_hash[j:j + count]
    return mix(out)


def repeated(doc: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Masks of the items whose key occurs again in the document, and of those
    that repeat an earlier item. Items come in document and text order."""
    seen_again = np.zeros(len(key), dtype=bool)
    later = np.zeros(len(key), dtype=bool)
    if len(key):
        order = np.lexsort((key, doc))
        same = (key[order][1:] == key[order][:-1]) & (doc[order][1:] == doc[order][:-1])
        later[order[1:][same]] = True
        seen_again[order[1:][same]] = True
        seen_again[order[:-1][same]] = True
    return seen_again, later
