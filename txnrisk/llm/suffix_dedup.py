"""Suffix-array deduplication of long byte strings.

A byte goes if a ``LENGTH``-byte string covers it that also starts earlier in
the corpus (smaller doc_id, or earlier in the same document).

Suffixes are dealt out so that equal LENGTH-byte prefixes meet: such a window
is sent by its anchor, its ANCHOR-byte substring of least hash. Windows that
share an anchor are one segment of text (about 35 windows long). A first pass
counts anchors, only segments whose anchor occurs again are sent on, and equal
segments collapse in their chunk and again in the bucket. In a bucket, each
shard (the chunks' segments, in turns) gets its Burrows-Wheeler transform over
blocks of BLOCK bytes; the shards' transforms are merged by interleave
refinement (``bwt``), whose borders give the intervals of windows with LENGTH
bytes in common. All but the earliest window of an interval are repeats and go
back to their chunk, where the bytes they cover are cut.

Texts travel as chunks of about a megabyte, packed once into a staged table.
Anchors and blocks are compared by 64-bit hashes.

Null text counts as empty. Rows with equal ids are ordered by their place in
the table; null ids come last. Every row of the input gives one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bwt import merge, shard_bwt
from .bytewords import Hasher, give_back, mix
from .common import stage

LENGTH, ANCHOR, BLOCK, SHARDS = 100, 32, 20, 8
CHUNK_BYTES = 500_000
BUCKETS_PER_PARTITION = 4  # of the shuffle; a bucket is what a task holds at once
LAST = np.iinfo(np.int64).max
_U = np.uint64
REPEAT = np.dtype([("row", "<u4"), ("first", "<u4"), ("last", "<u4")])  # window starts first .. last
SEGMENT = np.dtype([("anchor", "<u8"), ("doc_id", "<i8"), ("row", "<u4"), ("start", "<u4"), ("size", "<u4")])


def packed_chunks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(chunk, ids, sizes, data): documents as chunks of bytes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        press = zstandard.ZstdCompressor(level=3)
        task = TaskContext.get().partitionId()
        ids: list[int] = []
        parts: list[bytes] = []
        count = held = 0

        def pack() -> pd.DataFrame:
            nonlocal ids, parts, count, held
            row = {"chunk": [task << 32 | count], "ids": [np.array(ids, "<i8").tobytes()],
                   "sizes": [np.array(list(map(len, parts)), "<i8").tobytes()], "data": [press.compress(b"".join(parts))]}
            ids, parts, held = [], [], 0
            count += 1
            return pd.DataFrame(row)

        for b in batches:
            for doc, text in zip(b["doc_id"], b["text"], strict=True):
                ids.append(LAST if pd.isna(doc) else int(doc))
                parts.append(b"" if text is None else text.encode("utf-8", "surrogatepass"))
                held += len(parts[-1]) + 1
                if held >= CHUNK_BYTES:
                    yield pack()
        if ids:
            yield pack()
        give_back()

    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return src.mapInPandas(run, "chunk long, ids binary, sizes binary, data binary")


class Segments:
    """The windows of a chunk, as runs that share an anchor."""

    def __init__(self, ids: bytes, sizes: bytes, data: bytes):
        self.ids, self.size = np.frombuffer(ids, "<i8"), np.frombuffer(sizes, "<i8")
        total = int(self.size.sum())
        raw = zstandard.ZstdDecompressor().decompress(data, max_output_size=total) if total else b""
        self.buf = np.frombuffer(raw, dtype=np.uint8)
        self.doc_end = np.cumsum(self.size)
        self.doc_start = self.doc_end - self.size
        n, span = len(self.buf), LENGTH - ANCHOR + 1
        self.first = self.last = self.row = np.zeros(0, dtype=np.int64)
        self.anchor = np.zeros(0, dtype=np.uint64)
        if n < LENGTH:
            return
        self.hash = Hasher(self.buf)
        at = np.arange(n - ANCHOR + 1)
        gram = self.hash(at, at + ANCHOR)
        # least hash of each window, and its place, as one number
        key = gram & _U(0xFFFFFFFF00000000) | at.astype(np.uint64)
        low = _least(key, span)
        pick = (low & _U(0xFFFFFFFF)).astype(np.int64)
        doc = np.repeat(np.arange(len(self.size)), self.size)[:len(pick)]
        whole = np.arange(len(pick)) + LENGTH <= self.doc_end[doc]
        fresh = whole.copy()
        fresh[1:] &= (pick[1:] != pick[:-1]) | ~whole[:-1] | (doc[1:] != doc[:-1])
        close = whole.copy()
        close[:-1] &= fresh[1:] | ~whole[1:]
        self.first, self.last = np.flatnonzero(fresh), np.flatnonzero(close)
        self.row = doc[self.first]
        self.anchor = mix(gram[pick[self.first]])

    def by_bucket(self, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Segments in the order of their buckets, and where each bucket begins."""
        bucket = (self.anchor % _U(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def _least(key: np.ndarray, span: int) -> np.ndarray:
    """Minimum of each ``span`` consecutive keys."""
    n = len(key)
    wide = np.full(-(-n // span) * span, np.iinfo(np.uint64).max, dtype=np.uint64)
    wide[:n] = key
    rows = wide.reshape(-1, span)
    up = np.minimum.accumulate(rows, axis=1).ravel()
    down = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(down[:n - span + 1], up[span - 1:n])


def _anchors_again(chunks: DataFrame, buckets: int) -> DataFrame:
    """(chunk, bucket, flags): which segments' anchors, in bucket order, occur
    more than once in the corpus."""

    def sent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for chunk, *packed in b[["chunk", "ids", "sizes", "data"]].itertuples(index=False):
                s = Segments(*packed)
                order, edge = s.by_bucket(buckets)
                token = (s.anchor[order] // _U(buckets)).astype("<u4")
                has = np.flatnonzero(np.diff(edge))
                yield pd.DataFrame({"bucket": has, "chunk": chunk,
                                    "tokens": [token[edge[k]:edge[k + 1]].tobytes() for k in has]})
                del s, order, edge, token
                give_back()

    def counted(rows: pd.DataFrame) -> pd.DataFrame:
        parts = [np.frombuffer(x, "<u4") for x in rows["tokens"]]
        _, at, n = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        again = np.split(n[at] > 1, np.cumsum([len(p) for p in parts])[:-1])
        give_back()
        return pd.DataFrame({"chunk": rows["chunk"], "bucket": rows["bucket"],
                             "flags": [np.packbits(x).tobytes() for x in again]})

    return (chunks.mapInPandas(sent, "bucket int, chunk long, tokens binary")
            .groupBy("bucket").applyInPandas(counted, "chunk long, bucket int, flags binary"))


def _collapse(same: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of items with equal ``same`` the first in ``order`` (ranks): which items
    are first, and which are not."""
    by = np.lexsort((order, same))
    again = np.zeros(len(same), dtype=bool)
    again[by[1:]] = same[by][1:] == same[by][:-1]
    return np.flatnonzero(~again), np.flatnonzero(again)


def _bytes_of(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    end = np.cumsum(size)
    return buf[np.repeat(start - (end - size), size) + np.arange(int(size.sum()))]


def _segments_again(chunks: DataFrame, flagged: DataFrame, buckets: int) -> DataFrame:
    """(bucket, chunk, kind, blob). Kind 1: a chunk's distinct segments for a
    bucket (SEGMENT records, then their bytes). Kind 0: repeats found inside
    the chunk (REPEAT records)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        press = zstandard.ZstdCompressor(level=3)
        for b in batches:
            for chunk, ids, sizes, data, flags in b[["chunk", "ids", "sizes", "data", "flags"]].itertuples(index=False):
                s = Segments(ids, sizes, data)
                order, edge = s.by_bucket(buckets)
                again = np.zeros(len(order), dtype=bool)
                for f in flags:
                    k = f["bucket"]
                    n = edge[k + 1] - edge[k]
                    again[edge[k]:edge[k + 1]] = np.unpackbits(np.frombuffer(f["flags"], np.uint8), count=n)
                use = order[again]
                if not len(use):
                    continue
                size = s.last[use] + LENGTH - s.first[use]
                whole = s.hash(s.first[use], s.first[use] + size)
                rank = np.empty(len(use), dtype=np.int64)
                rank[np.lexsort((s.first[use], s.row[use], s.ids[s.row[use]]))] = np.arange(len(use))
                first, rest = _collapse(mix(whole + size.astype(np.uint64)), rank)
                first.sort()
                rows = []
                if len(rest):
                    rows.append((int(chunk % buckets), chunk, 0, _repeats(s, use[rest]).tobytes()))
                record = np.zeros(len(first), dtype=SEGMENT)
                mine = use[first]
                record["anchor"], record["doc_id"], record["row"] = s.anchor[mine], s.ids[s.row[mine]], s.row[mine]
                record["start"], record["size"] = s.first[mine] - s.doc_start[s.row[mine]], size[first]
                bucket = (s.anchor[mine] % _U(buckets)).astype(np.int64)
                cut = np.flatnonzero(np.diff(bucket)) + 1
                for part in np.split(np.arange(len(mine)), cut):
                    text = _bytes_of(s.buf, s.first[mine[part]], size[first][part])
                    rows.append((int(bucket[part[0]]), chunk, 1, press.compress(
                        np.uint32(len(part)).tobytes() + record[part].tobytes() + text.tobytes())))
                yield pd.DataFrame(rows, columns=["bucket", "chunk", "kind", "blob"])
        give_back()

    own = flagged.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "flags")).alias("flags"))
    return chunks.join(own, "chunk").mapInPandas(run, "bucket int, chunk long, kind int, blob binary")


def _repeats(s: Segments, segment: np.ndarray) -> np.ndarray:
    out = np.zeros(len(segment), dtype=REPEAT)
    row = s.row[segment]
    out["row"], out["first"], out["last"] = row, s.first[segment] - s.doc_start[row], s.last[segment] - s.doc_start[row]
    return out


def _bucket_repeats(sent: DataFrame) -> DataFrame:
    """(chunk, blob): REPEAT records of a bucket's chunks, and those of kind 0."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        own = rows.loc[rows["kind"] == 0, ["chunk", "blob"]]
        rows = rows[rows["kind"] == 1]
        if not len(rows):
            return own
        records, texts, sources = [], [], []
        for k, blob in enumerate(map(zstandard.ZstdDecompressor().decompress, rows["blob"])):
            n = int(np.frombuffer(blob, "<u4", 1)[0])
            records.append(np.frombuffer(blob, SEGMENT, n, 4))
            texts.append(np.frombuffer(blob, np.uint8, -1, 4 + n * SEGMENT.itemsize))
            sources.append(np.full(n, k))
        r, buf, source = np.concatenate(records), np.concatenate(texts), np.concatenate(sources)
        chunk = rows["chunk"].to_numpy(dtype=np.int64)
        size = r["size"].astype(np.int64)
        begin = np.cumsum(size) - size
        hasher = Hasher(buf)
        rank = np.empty(len(r), dtype=np.int64)
        rank[np.lexsort((r["start"], r["row"], chunk[source], r["doc_id"]))] = np.arange(len(r))
        first, rest = _collapse(mix(hasher(begin, begin + size) + r["size"]), rank)
        found = [(rest, r["start"][rest], r["start"][rest] + size[rest] - LENGTH)]
        # segments that differ but share an anchor
        _, at, n = np.unique(r["anchor"][first], return_inverse=True, return_counts=True)
        mixed = first[n[at] > 1]
        if len(mixed):
            found.append(_merged(r, buf, begin, size, rank, source, mixed))
        seg = np.concatenate([f[0] for f in found]).astype(np.int64)
        out = np.zeros(len(seg), dtype=REPEAT)
        out["row"] = r["row"][seg]
        out["first"], out["last"] = (np.concatenate([f[k] for f in found]) for k in (1, 2))
        home = chunk[source[seg]]
        by = np.argsort(home, kind="stable")
        cut = np.flatnonzero(np.diff(home[by])) + 1
        parts = [p for p in np.split(by, cut) if len(p)]
        found = pd.DataFrame({"chunk": [int(home[p[0]]) for p in parts], "blob": [out[p].tobytes() for p in parts]})
        give_back()
        return pd.concat([own, found], ignore_index=True)

    return sent.groupBy("bucket").applyInPandas(run, "chunk long, blob binary")


def _merged(r: np.ndarray, buf: np.ndarray, begin: np.ndarray, size: np.ndarray, rank: np.ndarray, source: np.ndarray,
            mixed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, first, last window start) of the repeated windows among the
    segments ``mixed``, by merging their shards' transforms."""
    text = _bytes_of(buf, begin[mixed], size[mixed])
    end = np.cumsum(size[mixed])
    start = end - size[mixed]
    at = np.arange(max(0, len(text) - BLOCK + 1))
    _, symbol = np.unique(Hasher(text)(at, at + BLOCK), return_inverse=True)
    symbol = symbol.astype(np.uint32) + np.uint32(1)
    _, place = np.unique(source[mixed], return_inverse=True)
    shards = [shard_bwt(symbol, start[mine], end[mine] - BLOCK + 1, BLOCK, LENGTH // BLOCK)
              for mine in (np.flatnonzero(place % SHARDS == k) for k in range(SHARDS)) if len(mine)]
    position, common = merge(shards)
    interval = np.cumsum(common < LENGTH // BLOCK)
    segment_at = np.searchsorted(end, position, side="right")  # ends have position -1
    window = (position >= 0) & (position + LENGTH <= end[np.minimum(segment_at, len(end) - 1)])
    position, interval, segment_at = position[window], interval[window], segment_at[window]
    _, again = _collapse(interval, rank[mixed][segment_at])
    again = again[np.argsort(position[again], kind="stable")]
    position, segment_at = position[again], segment_at[again]
    fresh = np.ones(len(again), dtype=bool)
    fresh[1:] = (position[1:] != position[:-1] + 1) | (segment_at[1:] != segment_at[:-1])
    close = np.append(fresh[1:], True) if len(again) else fresh
    seg = segment_at[fresh]
    base = r["start"][mixed[seg]] - start[seg]
    return mixed[seg], position[fresh] + base, position[close] + base


def _cut(chunks: DataFrame, repeats: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for ids, sizes, data, blobs in b[["ids", "sizes", "data", "blobs"]].itertuples(index=False):
                ids, size = np.frombuffer(ids, "<i8"), np.frombuffer(sizes, "<i8")
                total = int(size.sum())
                raw = zstandard.ZstdDecompressor().decompress(data, max_output_size=total) if total else b""
                buf = np.frombuffer(raw, np.uint8)
                end = np.cumsum(size)
                cover = np.zeros(total + 1, dtype=np.int32)
                for blob in blobs if blobs is not None else ():
                    x = np.frombuffer(blob, REPEAT)
                    at = (end - size)[x["row"]]
                    np.add.at(cover, at + x["first"], 1)
                    np.add.at(cover, at + x["last"] + LENGTH, -1)
                gone = np.cumsum(cover[:-1]) > 0
                edge = gone.copy()
                edge[1:] &= ~gone[:-1]
                edge[(end - size)[size > 0]] = gone[(end - size)[size > 0]]  # no run crosses documents
                sums = [np.concatenate(([0], np.cumsum(m))) for m in (gone, edge)]
                removed, spans = (x[end] - x[end - size] for x in sums)
                kept = buf[~gone].tobytes()
                to = np.cumsum(size - removed)
                yield pd.DataFrame({
                    "doc_id": pd.array(np.where(ids == LAST, 0, ids), dtype="Int64").copy(), "n_bytes": size,
                    "n_removed": removed, "n_spans": spans,
                    "kept": [kept[a:z] for a, z in zip(to - (size - removed), to, strict=True)],
                }).assign(doc_id=lambda f, ids=ids: f["doc_id"].mask(ids == LAST))
        give_back()

    own = repeats.groupBy("chunk").agg(F.collect_list("blob").alias("blobs"))
    return chunks.join(own, "chunk", "left").mapInPandas(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) for every row; ``kept`` is
    what is left of the text's bytes."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = BUCKETS_PER_PARTITION * max(2, partitions)
    chunks = stage(packed_chunks(docs, id_col, text_col), "suffix-chunks")
    sent = _segments_again(chunks, _anchors_again(chunks, buckets), buckets)
    return _cut(chunks, _bucket_repeats(sent))
