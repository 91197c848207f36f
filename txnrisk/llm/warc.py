"""WARC archives and a two-level capture index.

``write_archive`` writes every page as a gzip member of a WARC file (one file
per task) in the shared folder. Of pages with equal payloads of at least
``least_bytes`` bytes the one with the largest id is a ``response`` and the
others are ``revisit`` records that refer to it. A task names its files after
its attempt and returns (file, offset, length) rows; only the files that the
committed rows name belong to the archive, so lost or repeated tasks leave at
most stray files.

``write_index`` range-sorts the captures by reversed-host key (id as the
second part), and writes each range as one index file: compressed blocks of
``block_lines`` lines, then a sparse directory (first key, offset and length of
each block). ``lookup`` sends a key to its file by binary search over the
files' first keys (one per index file, so bounded by the number of files),
then searches the file's directory, range-reads one block and searches that.
``read_records`` range-reads the captures found.

Files are opened through ``pyarrow.fs`` by the URI of the shared folder.

Null html is an empty payload, null urls have an empty key. Repeated rows are
separate captures under one key. A null page_id never becomes the response of
equal payloads unless all their ids are null; then each is a response.
"""

from __future__ import annotations

import gzip
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shared_path
from .common import stage

CAPTURES = "sort_key string, page_id long, record_type string, file string, offset long, length long"
RECORDS = ("page_id long, target_uri string, record_type string, payload binary, declared_digest string, "
           "refers_to long")
SOFTWARE = "1.1"


def surt(url: Column) -> Column:
    """``http://www.a.org/x?y`` -> ``org,a,www)/x?y``; without a scheme, the url itself."""
    parts = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/@?#]*@)?([^/?#:]*)(?::[0-9]*)?(.*)$"
    host = F.regexp_extract(url, parts, 1)
    key = F.concat(F.array_join(F.reverse(F.split(F.lower(host), r"\.")), ","), F.lit(")"),
                   F.regexp_extract(url, parts, 2))
    # white space ends the key in an index line
    return F.regexp_replace(F.coalesce(F.when(url.rlike(parts), key), url, F.lit("")), r"\s", "%20")


def sort_key(url: Column, page_id: Column) -> Column:
    """Key and id as one string whose bytes sort like (key, id), null ids first."""
    rank = F.lpad(F.hex(page_id.bitwiseXOR(F.lit(-(2 ** 63)))), 16, "0")
    return F.concat(surt(url), F.lit(" "), F.coalesce(rank, F.lit("-")))


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _task_file(folder: str, ending: str):
    """An output stream for this task attempt, and the file's name."""
    store, path = _open(folder)
    store.create_dir(path, recursive=True)
    task = TaskContext.get()
    name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}.{ending}"
    return store.open_output_stream(f"{path}/{name}", compression=None), name


def _record(page_id: int | None, url: str, kind: str, digest: str, payload: bytes, refers_to: int | None) -> bytes:
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {' '.join(url.split())}",
            f"WARC-Payload-Digest: sha1:{digest}"]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{refers_to}>"]
        payload = b""
    else:
        head.append("Content-Type: text/html; charset=utf-8")
    head.append(f"Content-Length: {len(payload)}")
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n", 4, mtime=0)


def parse_record(member: bytes) -> dict:
    """The fields of ``RECORDS`` from one gzip member."""
    head, _, rest = gzip.decompress(member).partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    field = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}

    def page(value: str | None) -> int | None:
        number = (value or "")[len("<urn:page:"):-1]
        return int(number) if number else None

    kind = field["warc-type"]
    return {"page_id": page(field["warc-record-id"]), "target_uri": field.get("warc-target-uri", ""),
            "record_type": kind, "payload": None if kind == "revisit" else rest[:int(field["content-length"])],
            "declared_digest": field["warc-payload-digest"].removeprefix("sha1:"),
            "refers_to": page(field.get("warc-refers-to"))}


def _ints(x: pd.Series) -> list[int | None]:
    return [None if pd.isna(v) else int(v) for v in x]


def write_archive(pages: DataFrame, least_bytes: int = 1000, folder: str | None = None) -> tuple[str, DataFrame]:
    """Folder of the WARC files, and the captures in them."""
    folder = folder or shared_path(pages.sparkSession, f"warc-{uuid.uuid4().hex}")
    src = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                       F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    src = src.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    large = F.octet_length("html") >= least_bytes
    shared = (src.where(large).groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
              .where("n > 1").drop("n"))
    rows = src.join(shared, "digest", "left")
    revisit = F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    rows = rows.select(sort_key(F.col("url"), F.col("page_id")).alias("sort_key"), "page_id",
                       F.coalesce("url", F.lit("")).alias("url"), "html", "digest",
                       F.when(revisit, F.col("refers_to")).alias("refers_to"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = None
        at = 0
        for b in batches:
            if out is None:
                out, name = _task_file(folder, "warc.gz")
            rows = []
            for key, page, url, html, digest, refers in zip(b["sort_key"], _ints(b["page_id"]), b["url"], b["html"],
                                                            b["digest"], _ints(b["refers_to"]), strict=True):
                kind = "response" if refers is None else "revisit"
                member = _record(page, url, kind, digest, html.encode("utf-8", "surrogatepass"), refers)
                out.write(member)
                rows.append((key, page, kind, name, at, len(member)))
                at += len(member)
            yield pd.DataFrame(rows, columns=["sort_key", "page_id", "record_type", "file", "offset", "length"]).astype(
                {"page_id": "Int64"})
        if out is not None:
            out.close()

    return folder, stage(rows.mapInPandas(run, CAPTURES), "warc-captures")


@dataclass
class Index:
    folder: str
    files: list[tuple[bytes, str]]  # first key of each index file, in order


def write_index(captures: DataFrame, block_lines: int = 512, folder: str | None = None) -> Index:
    folder = folder or shared_path(captures.sparkSession, f"warc-index-{uuid.uuid4().hex}")
    ranges = captures.repartitionByRange("sort_key").sortWithinPartitions("sort_key", "file", "offset")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = None
        at = 0
        directory: list[tuple[str, int, int]] = []
        lines: list[str] = []

        def close_block() -> None:
            nonlocal at, lines
            block = zlib.compress("\n".join(lines).encode(), 6)
            out.write(block)
            directory.append((lines[0].partition("\t")[0], at, len(block)))
            at += len(block)
            lines = []

        for b in batches:
            if out is None:
                out, name = _task_file(folder, "cdx")
            for key, kind, file, offset, length in zip(b["sort_key"], b["record_type"], b["file"], b["offset"],
                                                       b["length"], strict=True):
                lines.append(f"{key}\t{kind}\t{file}\t{offset}\t{length}")
                if len(lines) >= block_lines:
                    close_block()
        if out is not None:
            if lines:
                close_block()
            tail = zlib.compress(json.dumps(directory).encode())
            out.write(tail + len(tail).to_bytes(8, "little"))
            out.close()
            yield pd.DataFrame({"first_key": [directory[0][0]], "file": [name]})

    written = stage(ranges.mapInPandas(run, "first_key string, file string"), "warc-index-files")
    return Index(folder, sorted((r["first_key"].encode(), r["file"]) for r in written.collect()))


class IndexFile:
    """One index file: its directory in memory, blocks by range read."""

    def __init__(self, folder: str, name: str):
        store, path = _open(folder)
        self.file = store.open_input_file(f"{path}/{name}")
        size = self.file.size()
        n = int.from_bytes(self.file.read_at(8, size - 8), "little")
        self.blocks = json.loads(zlib.decompress(self.file.read_at(n, size - 8 - n)))
        self.first = [b[0].encode() for b in self.blocks]
        self.held: tuple[int, list[bytes], list[bytes]] = (-1, [], [])

    def block(self, k: int) -> tuple[list[bytes], list[bytes]]:
        if self.held[0] != k:
            _, at, n = self.blocks[k]
            lines = zlib.decompress(self.file.read_at(n, at)).split(b"\n")
            self.held = (k, [x.partition(b"\t")[0] for x in lines], lines)
        return self.held[1:]

    def find(self, key: bytes) -> Iterator[list[str]]:
        """The fields after the key of all its lines, which may span blocks."""
        k = max(0, bisect_left(self.first, key) - 1)
        while k < len(self.first) and self.first[k] <= key:
            keys, lines = self.block(k)
            for line in lines[bisect_left(keys, key):bisect_right(keys, key)]:
                yield line.decode().split("\t")[1:]
            k += 1


def lookup(keys: DataFrame, index: Index) -> DataFrame:
    """Captures of the distinct ``sort_key`` values in ``keys``."""
    first = [k for k, _ in index.files]
    names = [n for _, n in index.files]
    folder = index.folder

    @F.pandas_udf("int")
    def file_of(key: pd.Series) -> pd.Series:
        return key.map(lambda k: bisect_right(first, k.encode()) - 1).astype("int32")

    sent = (keys.select("sort_key").distinct().withColumn("at", file_of("sort_key")).where("at >= 0")
            .repartitionByRange("at", "sort_key").sortWithinPartitions("at", "sort_key"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, part = -1, None
        for b in batches:
            rows = []
            for key, file in zip(b["sort_key"], b["at"], strict=True):
                if file != at:
                    at, part = file, IndexFile(folder, names[file])
                rows += [(key, kind, name, int(offset), int(length))
                         for kind, name, offset, length in part.find(key.encode())]
            yield pd.DataFrame(rows, columns=["sort_key", "record_type", "file", "offset", "length"])

    return sent.mapInPandas(run, "sort_key string, record_type string, file string, offset long, length long")


def read_records(found: DataFrame, folder: str) -> DataFrame:
    """The records of ``found`` (file, offset, length), by range reads in file order."""
    order = found.select("file", "offset", "length").repartitionByRange("file", "offset")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, path = _open(folder)
        at, file = None, None
        for b in batches:
            rows: list[dict] = []
            held = 0
            for name, offset, length in zip(b["file"], b["offset"], b["length"], strict=True):
                if name != at:
                    at, file = name, store.open_input_file(f"{path}/{name}")
                rows.append(parse_record(file.read_at(int(length), int(offset))))
                held += len(rows[-1]["payload"] or b"")
                if held > 16_000_000:
                    yield _frame(rows)
                    rows, held = [], 0
            yield _frame(rows)

    return order.sortWithinPartitions("file", "offset").mapInPandas(run, RECORDS)


def _frame(rows: list[dict]) -> pd.DataFrame:
    names = [x.split()[0] for x in RECORDS.split(", ")]
    return pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})


def archive_round_trip(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """Write, index, look every page up and read it back: (page_id,
    payload_bytes, payload_digest, record_type, refers_to). Sizes and digests
    are those of the payload read; a revisit's are its response's."""
    folder, captures = write_archive(pages, least_bytes)
    index = write_index(captures)
    keys = pages.select(sort_key(F.col("url").cast("string"), F.col("page_id").cast("long")).alias("sort_key"))
    records = read_records(lookup(keys, index), folder)
    read = stage(records.select("page_id", "record_type", "refers_to", F.octet_length("payload").cast("long").alias("payload_bytes"),
                                F.sha1("payload").alias("payload_digest"), "declared_digest"), "warc-read")
    own = read.where("record_type = 'response'")
    wanted = own.select(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("declared_digest"),
                        "payload_bytes", "payload_digest").dropDuplicates(["refers_to", "declared_digest"])
    seen = (read.where("record_type = 'revisit'").drop("payload_bytes", "payload_digest")
            .join(wanted, ["refers_to", "declared_digest"], "left"))
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return own.select(names).unionByName(seen.select(names))
