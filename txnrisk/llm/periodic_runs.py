"""Periodic runs of words: detection and collapse.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical) of at least max(least, 4 q) words that no neighbour extends
keeping period q. Collapsing keeps the first q words of each run; a word goes
if any run holds it after that run's first q words.

Periods are searched octave by octave. In the octave of periods S to 2 S - 1 a
document is exploded into overlapping tiles with a boundary at every S-th word.
The places i whose word equals that q further on form a stretch of at least
3 q, so it holds a boundary c together with the 2 S places from c. Boundaries
where no later word of the octave begins the same 2 S words (by a rolling hash)
are passed over; for the others Z-functions of the words after and, reversed,
before the boundary give how far every period of the octave reaches either
way, clipped to a fragment that overlaps or touches the next boundary's. The
same Z-function tells periods that a shorter one makes up. Work is in
proportion to words times octaves.

Fragments are shuffled by document and period and stitched where they meet.
Tiles of documents of up to ``long_words`` words are solved where the document
is read; those of longer documents are rows of their own, dealt out over all
tasks. A task holds a batch of documents, or tiles, and a document's own runs
meet in one task. What is read again is written to the shared folder first.

Null texts have no words; null and repeated ids are kept, each row for itself;
an empty table gives an empty result; only the two named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bytewords import give_back
from .common import stage

LEAST = 6
REPEATS = 4
FRAGMENTS = "array<struct<q:long,s:long,e:long>>"
READ = (f"row long, doc_id long, n_words long, words string, plain_sha256 string, fragments {FRAGMENTS}, "
        "octave int, lo long, hi long, base long, tile binary")
RUNS = "array<struct<start:long,period:long,length:long>>"


def z_values(s: list[int]) -> list[int]:
    """For each place the length of the longest common prefix with the whole."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def prime_factors(n: int) -> list[int]:
    found, p = [], 2
    while p * p <= n:
        if n % p == 0:
            found.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return [*found, n] if n > 1 else found


def next_grams(h: np.ndarray, m: int) -> np.ndarray:
    """Hashes of 2 m words from those of m words."""
    if len(h) <= m:
        return h[:0]
    x = h[:-m] * np.uint64(0x9E3779B97F4A7C15) + h[m:]
    x ^= x >> np.uint64(29)
    return x * np.uint64(0xBF58476D1CE4E5B9)


def first_grams(words: np.ndarray) -> np.ndarray:
    return (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)


def octave_fragments(w: np.ndarray, grams: np.ndarray, s: int, base: int, lo: int, hi: int) -> list[tuple[int, int, int]]:
    """(period, from, to) of the places i with word i = word i + period around
    the boundaries from lo to hi - 1, merged. ``w`` holds the words from number
    ``base`` on, ``grams`` their hashes by 2 s words."""
    at = -(-max(lo, base) // s) * s - base  # first boundary, in w
    last = min(hi - base, len(w))
    n_bounds = -(-(last - at) // s) if last > at else 0
    reach = min(len(grams) - at - s, n_bounds * s)
    if reach <= 0:
        return []
    hits = np.flatnonzero(grams[at + s:at + s + reach] == np.repeat(grams[at:at + n_bounds * s:s], s)[:reach])
    found, factors = [], {}
    bounds, starts = np.unique(hits // s, return_index=True)
    for j, i, k in zip(bounds.tolist(), starts.tolist(), [*starts[1:].tolist(), len(hits)]):
        c = at + j * s
        after = z_values(w[c:c + 5 * s].tolist())
        before = w[max(0, c - s):c][::-1].tolist()
        top = min(c + 2 * s - 1, len(w))
        back = z_values([*before, -1, *w[c:top][::-1].tolist()])
        for q in (hits[i:k] - j * s + s).tolist():
            ahead = min(after[q], 3 * s)
            if ahead < 2 * s:
                continue  # equal hashes of different words
            if q not in factors:
                factors[q] = [q // p for p in prime_factors(q)]
            if any(after[p] >= q - p for p in factors[q]):
                continue  # a shorter period makes it up
            found.append((q, base + c - min(back[len(before) + 1 + top - (c + q)], len(before)), base + c + ahead))
    return merged(found)


def merged(fragments: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    out: list[tuple[int, int, int]] = []
    for q, s, e in sorted(fragments):
        if out and out[-1][0] == q and s <= out[-1][2]:
            out[-1] = (q, out[-1][1], max(e, out[-1][2]))
        else:
            out.append((q, s, e))
    return out


def octaves(n: int) -> Iterator[int]:
    """The octaves whose periods fit four times into n words."""
    k = 0
    while n >= LEAST and REPEATS << k <= n:
        yield k
        k += 1


def tiles(n: int, octave: int, tile_words: int) -> Iterator[tuple[int, int, int, int]]:
    """(lo, hi, base, end): boundaries and words of each tile of an octave."""
    s = 1 << octave
    step = -(-max(tile_words, 8 * s) // s) * s
    for lo in range(0, n, step):
        yield lo, lo + step, max(0, lo - s), min(n, lo + step + 5 * s)


def solve_whole(w: np.ndarray) -> list[tuple[int, int, int]]:
    """All stretches of a document that is its own tile in every octave."""
    found, grams = [], first_grams(w)
    for k in octaves(len(w)):
        grams = next_grams(grams, 1 << k)
        found += octave_fragments(w, grams, 1 << k, 0, 0, len(w))
    return [(q, s, e) for q, s, e in found if e - s + q >= max(LEAST, REPEATS * q)]


def solve_tile(w: np.ndarray, octave: int, lo: int, hi: int, base: int) -> list[tuple[int, int, int]]:
    grams = first_grams(w)
    for k in range(octave + 1):
        grams = next_grams(grams, 1 << k)
    return octave_fragments(w, grams, 1 << octave, base, lo, hi)


def _listed(fragments: list[tuple[int, int, int]]) -> list[dict]:
    return [{"q": q, "s": s, "e": e} for q, s, e in fragments]


def read_documents(docs: DataFrame, id_col: str, text_col: str, tile_words: int, long_words: int) -> DataFrame:
    """A row per document, with its words if it may hold runs, and a row per
    tile of a long document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        row = TaskContext.get().partitionId() << 40
        names = [c.split()[0] for c in READ.replace(FRAGMENTS, "array").split(", ")]
        for batch in batches:
            rows, held = [], 0
            for i, text in zip(batch["doc_id"], batch["text"], strict=True):
                doc = None if pd.isna(i) else int(i)
                words = text.encode().split() if text else []
                n, joined = len(words), b" ".join(words)
                number = {x: k for k, x in enumerate(dict.fromkeys(words))}
                w = np.fromiter(map(number.__getitem__, words), np.int64, n)
                row += 1
                if n <= long_words:
                    found = solve_whole(w)
                else:
                    found = []
                    for k in octaves(n):
                        for lo, hi, base, end in tiles(n, k, tile_words):
                            tile = w[base:end].astype("<i4").tobytes()
                            rows.append((row, doc, n, None, None, [], k, lo, hi, base, tile))
                            held += len(tile)
                            if held > 16 << 20:
                                yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})
                                rows, held = [], 0
                rows.append((row, doc, n, joined.decode() if found or n > long_words else None,
                             hashlib.sha256(joined).hexdigest(), _listed(found), -1, 0, 0, 0, None))
            yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})
        give_back()

    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return stage(src.mapInPandas(run, READ), "periodic-read")


def _solved(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = [_listed(solve_tile(np.frombuffer(t, "<i4").astype(np.int64), k, lo, hi, base))
                 for t, k, lo, hi, base in zip(batch["tile"], batch["octave"], batch["lo"], batch["hi"], batch["base"])]
        yield pd.DataFrame({"row": batch["row"], "fragments": found})


def _collapsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = []
        for text, runs in zip(batch["words"], batch["runs"], strict=True):
            words = text.split(" ")
            over = np.zeros(len(words) + 1, dtype=np.int64)
            for r in runs:
                over[r["start"] + r["period"]] += 1
                over[r["start"] + r["length"]] -= 1
            texts.append(" ".join(w for w, k in zip(words, np.cumsum(over).tolist()) if k == 0))
        yield batch[["doc_id", "n_words", "runs"]].assign(collapsed=texts)


def stitched(fragments: DataFrame) -> DataFrame:
    """(row, start, period, length) of the runs from the fragments of their
    documents and periods."""
    ordered = Window.partitionBy("row", "q").orderBy("s", "e")
    reached = F.max("e").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(reached.isNull() | (F.col("s") > reached), 1).otherwise(0)
    parts = (fragments.withColumn("opens", opens)
                      .withColumn("island", F.sum("opens").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
                      .groupBy("row", "q", "island").agg(F.min("s").alias("start"), F.max("e").alias("end")))
    return (parts.select("row", "start", F.col("q").alias("period"), (F.col("end") - F.col("start") + F.col("q")).alias("length"))
                 .where(F.col("length") >= F.greatest(F.lit(LEAST), F.lit(REPEATS) * F.col("period"))))


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tile_words: int = 1 << 14,
                  long_words: int = 1 << 16) -> DataFrame:
    """Per document ``n_words``, its ``runs`` by start and period, the
    ``collapsed`` text (kept words joined by a space; null where no run was
    found and all words stay) and its ``collapsed_sha256`` (never null)."""
    read = read_documents(docs, id_col, text_col, tile_words, long_words)
    base = read.where("octave < 0")
    split = (read.where("octave >= 0").select("row", "octave", "lo", "hi", "base", "tile")
                 .repartition("row", "octave", "lo").mapInPandas(_solved, f"row long, fragments {FRAGMENTS}"))
    fragments = base.select("row", "fragments").union(split).select("row", F.inline("fragments"))
    runs = (stitched(fragments).groupBy("row")
                .agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("runs")))
    none = F.array().cast(RUNS)
    joined = stage(base.where("words is not null").select("row", "doc_id", "n_words", "words", "plain_sha256")
                       .join(runs, "row", "left"), "periodic-runs")
    shorter = (joined.where("runs is not null").select("doc_id", "n_words", "words", "runs")
                     .mapInPandas(_collapsed, f"doc_id long, n_words long, runs {RUNS}, collapsed string")
                     .withColumn("collapsed_sha256", F.sha2("collapsed", 256)))
    same = base.where("words is null").select("doc_id", "n_words", "plain_sha256").union(
        joined.where("runs is null").select("doc_id", "n_words", "plain_sha256"))
    return shorter.unionByName(same.select("doc_id", "n_words", none.alias("runs"), F.lit(None).cast("string").alias("collapsed"),
                                           F.col("plain_sha256").alias("collapsed_sha256")))
