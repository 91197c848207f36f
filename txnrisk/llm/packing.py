"""Packing: vector bin packing of token pieces into training sequences.

Every document becomes its token ids followed by an end id. Whole sequences'
worth of ids are cut off the front as full pieces; the rest (shorter than a
sequence) is an example with three sizes: tokens, segments (1) and
loss-bearing tokens. The dot-product heuristic fills one bin after another:
of the examples that still fit under all three limits, the one whose size
vector has the largest dot product with the bin's remaining capacity goes in.
A gap of at least ``min_cut`` tokens that no example fits is closed by cutting
the head off one.

Examples are packed where they are tokenised, in blocks of ``block`` examples:
no shuffle, a task holds one block, and a lost executor only repeats its own
partitions. Null text counts as empty (one end id); documents with equal or
null ids are packed like any other; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytewords import give_back

PIECES = ("doc_id long, start long, length long, doc_tokens long, loss_tokens long, "
          "sequence_id long, offset long, ids binary")
# A text with such a run goes to the reference tokenizer, whose merge loop is
# not quadratic in the length of a run.
LONG_RUN = re.compile(r"\S{2000}|\s{2000}")


class Encoder:
    """Ids of the byte-level BPE in a ``tokenizers`` JSON file.

    The vocabulary of that file doubles as merge ranks, so the faster tiktoken
    gives the same ids; texts with very long runs take ``tokenizers`` itself.
    The file is read where the job is planned; tasks get the ranks."""

    def __init__(self, path: str):
        import public_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        # Byte-level vocabularies show printable Latin-1 bytes as themselves
        # and the other bytes, in order, from code point 256 on.
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        byte_of = {chr(b): b for b in shown}
        byte_of |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
        self.path, self.pattern = path, public_tokenizers.PATTERN
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items()
                      if token not in self.special}

    def __getstate__(self) -> dict:
        return {k: v for k, v in vars(self).items() if k not in ("fast", "slow")}

    @cached_property
    def fast(self):
        import tiktoken

        return tiktoken.Encoding("pieces", pat_str=self.pattern, mergeable_ranks=self.ranks, special_tokens=self.special)

    @cached_property
    def slow(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def __call__(self, text: str) -> list[int]:
        if LONG_RUN.search(text):
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode(text, allowed_special="all")


def fill_bins(tokens: np.ndarray, loss: np.ndarray, limits: tuple[int, int, int], min_cut: int,
              ) -> list[list[tuple[int, int, int]]]:
    """Bins of (example, from, to) for examples shorter than ``limits[0]``.

    Ties go to the earlier example. Loss-bearing tokens are the last ones of an
    example, so a cut of its head takes ``n - (tokens - loss)`` of them."""
    cap = np.array(limits, dtype=np.float64)
    order = np.argsort(-tokens, kind="stable")
    size = np.stack([tokens, np.ones_like(tokens), loss], axis=1)[order].astype(np.float64)
    begin = np.zeros(len(order), dtype=np.int64)
    weight = size / cap
    left = np.ones(len(order), dtype=bool)
    n_left, bins = len(order), []
    while n_left:
        free, bin_ = cap.copy(), []
        while n_left and free[1] >= 1 and free[0] > 0:
            fits = left & (size <= free).all(axis=1)
            if fits.any():
                score = weight @ (free / cap)
                score[~fits] = -1.0
                k = int(score.argmax())
                bin_.append((int(order[k]), int(begin[k]), int(begin[k] + size[k, 0])))
                free -= size[k]
                left[k] = False
                n_left -= 1
                continue
            # nothing fits whole: close the gap with the head of the longest
            k = int(np.flatnonzero(left)[0])
            quiet = size[k, 0] - size[k, 2]  # leading tokens without loss
            n = min(free[0], size[k, 0], quiet + free[2])
            if bin_ and n < min_cut or n < 1:
                break
            bin_.append((int(order[k]), int(begin[k]), int(begin[k] + n)))
            took = np.array([n, 1.0, max(0.0, n - quiet)])
            free -= took
            size[k, 0] -= n
            size[k, 2] -= took[2]
            weight[k] = size[k] / cap
            begin[k] += int(n)
            if size[k, 0] <= 0:
                left[k] = False
                n_left -= 1
        if not bin_:
            raise ValueError("an example does not fit an empty sequence")
        bins.append(bin_)
    return bins


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                   length: int = 1024, max_segments: int = 64, max_loss_tokens: int | None = None,
                   end_id: int = 0, block: int = 4096, min_cut: int = 32) -> DataFrame:
    """Pieces of all documents with their place in a sequence and their ids
    (unsigned little-endian 32-bit). The first token of a document has no
    context and bears no loss; all others do. ``sequence_id`` is unique over
    the table, offsets within a sequence run without gaps from 0."""
    limits = (length, max_segments, max_loss_tokens or length)
    if min(limits) < 2:
        raise ValueError("limits must allow a piece with loss")

    encode = Encoder(tokenizer)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sequence = TaskContext.get().partitionId() << 40
        rest: list[tuple] = []  # doc_id, start, ids, doc_tokens
        out: list[tuple] = []
        held = 0

        def flush() -> None:
            nonlocal sequence, rest
            n = np.array([len(x[2]) for x in rest], dtype=np.int64)
            first = np.array([x[1] == 0 for x in rest], dtype=np.int64)
            for bin_ in fill_bins(n, n - first, limits, min_cut) if rest else []:
                at = 0
                for k, a, b in bin_:
                    doc, start, ids, total = rest[k]
                    out.append((doc, start + a, b - a, total, b - a - (start + a == 0), sequence, at,
                                ids[a:b].tobytes()))
                    at += b - a
                sequence += 1
            rest = []

        def frame() -> pd.DataFrame:
            nonlocal out, held
            done, out, held = out, [], 0
            got = pd.DataFrame(done, columns=["doc_id", "start", "length", "doc_tokens", "loss_tokens",
                                              "sequence_id", "offset", "ids"])
            return got.astype({"doc_id": "Int64"})

        full = min(length, limits[2])
        for batch in batches:
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                doc = None if pd.isna(doc) else int(doc)
                ids = np.array([*encode(text or ""), end_id], dtype="<u4")
                at = 0
                while len(ids) - at >= full:
                    out.append((doc, at, full, len(ids), full - (at == 0), sequence, 0, ids[at:at + full].tobytes()))
                    at += full
                    held += full
                    sequence += 1
                if at < len(ids):
                    rest.append((doc, at, ids[at:], len(ids)))
                    held += len(ids) - at
                if len(rest) >= block:
                    flush()
                if held > 1_000_000:
                    yield frame()
        flush()
        yield frame()
        vars(encode).pop("fast", None)
        give_back()

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInPandas(run, PIECES)
