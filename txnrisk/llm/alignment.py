"""Cross-tokenizer alignment with corpus-wide counts of linked id pairs.

Two tokenizers cut the same bytes. The offsets where tokens of both end cut a
text into groups; every token of one side is linked with every token of the
other in its group. Documents are read in blocks of some megabytes. A word
(with the space before it) is cut the same way wherever it stands and always
ends a group, so a block holds its distinct words once, with the ids of both
sides, and its documents as numbers of words.

First pass, per block: the distinct linked pairs with the number of documents
that hold each, spread over ``slices`` by a hash of the pair. Pairs of a slice
are united block by block in a reduction tree and get a minimal perfect hash
(``perfect_hash``) with the keys in its order, for verification. Count vectors
indexed by that hash are dense and summed in a tree. Second pass: each block's
pairs look their counts up, the block aligns its words again and weighs its
links.

Bounds: a block holds ``block_bytes`` of text or one document; a slice holds at
most ``1 / slices`` of |A| x |B| pairs; what a group of the tree reads is
``keys_per_group`` keys or some multiples of a slice; the highest counts per
id, which go to all tasks, are at most |A| numbers. Every step reads tables
written in the shared folder, so a lost executor repeats its own tasks.

Texts that are null or empty, or that a tokenizer does not give back byte by
byte, have no tokens and zeros in all counts. Documents with equal or null ids
are counted and returned one by one, an empty table gives an empty result, and
only the two named columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_stage_table
from .bytewords import give_back
from .common import stage
from .packing import LONG_RUN, Encoder
from .perfect_hash import PerfectHash, mixed

RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
          "groups string")
# A space that follows another or precedes other white space is no sure border.
ODD_SPACE = re.compile(r" (?=\s|$)")
BORDER = re.compile(r"(?<=[^ ])(?= \S)")
KNOWN_WORDS = 1 << 18
DOC_BITS = 20
CHUNK = 1 << 16  # occurrences of words whose pairs are listed at a time, or a document's
WIDE_GROUP = 4096  # links above which a group's pairs are counted instead of listed


class PlainEncoder(Encoder):
    """As ``Encoder``, but strings of special tokens in a text are text."""

    @cached_property
    def slow(self):
        from tokenizers import Tokenizer

        found = Tokenizer.from_file(self.path)
        found.encode_special_tokens = True
        return found

    def __call__(self, text: str) -> list[int]:
        if LONG_RUN.search(text):
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


class TwoTokenizers:
    """Ids of words under both tokenizers, and the bytes of every id."""

    def __init__(self, a_path: str, b_path: str):
        self.a = PlainEncoder(a_path)
        self.a_bytes = self._in_order(self.a.ranks | {i: s.encode() for s, i in self.a.special.items()})
        with open(b_path, "rb") as f:
            self.b_model = f.read()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        if any(re.search("[^▁]▁", p) for p in pieces):
            raise ValueError("a piece runs over a word's border")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.a_lengths = np.array(list(map(len, self.a_bytes)), dtype=np.int64)
        self.b_lengths = np.array(list(map(len, self.b_bytes)), dtype=np.int64)
        self.forget()

    @staticmethod
    def _in_order(ids: dict) -> list[bytes]:
        by_id = {i if isinstance(i, int) else ids[i]: i if isinstance(i, bytes) else ids[i] for i in ids}
        return [by_id.get(i, b"") for i in range(max(by_id) + 1)]

    def __getstate__(self) -> dict:
        return {k: v for k, v in vars(self).items() if k != "b"} | {"known": {}, "sides": [([], []), ([], [])]}

    @cached_property
    def b(self):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_proto=self.b_model)

    @staticmethod
    def words(text: str) -> list[str]:
        """The text with a space before it, cut before the spaces where no
        token of either side runs on; without the space that starts each."""
        spaced = " " + text
        if ODD_SPACE.search(spaced):
            return [w[1:] for w in BORDER.split(spaced)]
        return text.split(" ")

    def learn(self, words: list[str]) -> np.ndarray:
        """The numbers of distinct words under which ``cut`` gives their ids."""
        if len(self.known) > KNOWN_WORDS:
            self.forget()
        odd, plain = [], []
        for w in words:
            if w not in self.known:
                (odd if " " in w or w[0].isspace() else plain).append(w)
        if plain and not self._together(plain):
            odd += plain
        for w, b in zip(odd, self.b.encode(odd, num_threads=1) if odd else [], strict=True):
            a, whole = self.a(" " + w), (" " + w).encode()
            same = (b"".join(map(self.a_bytes.__getitem__, a)) == whole
                    and b"".join(map(self.b_bytes.__getitem__, b)) == whole)
            self._add([w], (a, b) if same else ([], []), ([len(a)], [len(b)]) if same else ([0], [0]))
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def _together(self, words: list[str]) -> bool:
        """Learn words that may stand in one text, where all of them are given
        back byte by byte."""
        text = " " + " ".join(words)
        whole = text.encode()
        a, per_word = self.a(text), self.b.encode(words, num_threads=1)
        b = list(chain.from_iterable(per_word))
        if (b"".join(map(self.a_bytes.__getitem__, a)) != whole
                or b"".join(map(self.b_bytes.__getitem__, b)) != whole):
            return False
        sizes = list(map(len, words)) if text.isascii() else [len(w.encode()) for w in words]
        ends, reached = np.cumsum(np.array(sizes) + 1), np.cumsum(self.a_lengths[a])
        stop = np.searchsorted(reached, ends) + 1
        n_b = np.array(list(map(len, per_word)))
        if (reached[stop - 1] != ends).any() or (np.cumsum(self.b_lengths[b])[np.cumsum(n_b) - 1] != ends).any():
            return False
        self._add(words, (a, b), (np.diff(stop, prepend=0), n_b))
        return True

    def _add(self, words: list[str], ids: tuple, counts: tuple) -> None:
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words))))
        for side, new, n in zip(self.sides, ids, counts):
            side[0].append(np.array(new, dtype=np.uint32))
            side[1].append(np.array(n, dtype=np.int64))

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.sides: list[tuple[list[np.ndarray], list[np.ndarray]]] = [([], []), ([], [])]

    def cut(self, numbers: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per side the ids of the words one after another, and how many each
        has: none on either side if a side does not give the word back."""
        out = []
        for ids, counts in self.sides:
            ids[:], counts[:] = [np.concatenate(ids)], [np.concatenate(counts)]
            times = counts[0][numbers]
            start = (np.cumsum(counts[0]) - counts[0])[numbers]
            at = np.repeat(start - np.cumsum(times) + times, times) + np.arange(times.sum())
            out.append((ids[0][at].astype(np.int64), times))
        return out


def pack(*arrays: np.ndarray) -> bytes:
    sizes = np.array([len(arrays), *map(len, arrays)], dtype="<i8")
    return zstandard.ZstdCompressor(level=1).compress(
        b"".join([sizes.tobytes(), *(np.asarray(a, dtype="<i8").tobytes() for a in arrays)]))


def unpack(data: bytes) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "<i8")
    ends = np.cumsum(raw[1:1 + raw[0]]) + 1 + raw[0]
    return [raw[e - n:e] for e, n in zip(ends, raw[1:1 + raw[0]], strict=True)]


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values; sorts in place."""
    values.sort()
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of a sorted array and how often each stands there."""
    at = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, dtype=np.int64)
    return ordered[at], np.diff(at, append=len(ordered))


class Aligned:
    """Words of a block, aligned: per word its groups, and its linked pairs as
    rows ``codes[from_[w]:from_[w + 1]]`` (a * |B| + b) with their numbers of
    links ``weights``."""

    def __init__(self, a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray,
                 a_lengths: np.ndarray, b_lengths: np.ndarray):
        self.a, self.b, self.n_a, self.n_b, n = a, b, n_a, n_b, len(n_a)
        a_end, b_end = np.cumsum(a_lengths[a]), np.cumsum(b_lengths[b])
        ends = a_end[np.isin(a_end, b_end)]
        self.a_group, self.b_group = np.searchsorted(ends, a_end), np.searchsorted(ends, b_end)
        self.a_in, self.b_in = np.bincount(self.a_group, minlength=len(ends)), np.bincount(self.b_group, minlength=len(ends))
        a_of = np.repeat(np.arange(n), n_a)  # word of an A token
        last = np.cumsum(self.a_in) - 1
        self.group_word = a_of[last]
        self.n_groups = np.bincount(self.group_word, minlength=n)
        self.n_links = np.zeros(n, dtype=np.int64)
        np.add.at(self.n_links, self.group_word, self.a_in * self.b_in)
        wide = self.a_in * self.b_in > WIDE_GROUP
        b_start = np.cumsum(self.b_in) - self.b_in
        # every A token of a narrow group beside every B token of the group
        times = np.where(wide, 0, self.b_in)[self.a_group]
        left = np.repeat(np.arange(len(a)), times)
        nth = np.arange(len(left)) - np.repeat(np.cumsum(times) - times, times)
        word = [a_of[left]]
        code = [a[left] * len(b_lengths) + b[b_start[self.a_group[left]] + nth]]
        weight = [np.ones(len(left), dtype=np.int64)]
        a_start = np.cumsum(self.a_in) - self.a_in
        for g in np.flatnonzero(wide).tolist():
            x, n_x = np.unique(a[a_start[g]:a_start[g] + self.a_in[g]], return_counts=True)
            y, n_y = np.unique(b[b_start[g]:b_start[g] + self.b_in[g]], return_counts=True)
            code.append((x[:, None] * len(b_lengths) + y).ravel())
            weight.append((n_x[:, None] * n_y).ravel())
            word.append(np.full(len(code[-1]), self.group_word[g]))
        word, code, weight = np.concatenate(word), np.concatenate(code), np.concatenate(weight)
        order = np.lexsort((code, word))
        word, code, weight = word[order], code[order], weight[order]
        new = np.ones(len(word), dtype=bool)
        new[1:] = (word[1:] != word[:-1]) | (code[1:] != code[:-1])
        first = np.flatnonzero(new)
        self.codes = code[first]
        self.weights = np.add.reduceat(weight, first) if len(first) else weight
        self.from_ = np.searchsorted(word[first], np.arange(n + 1))

    def doc_pairs(self, word: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The distinct pairs of documents given as occurrences of words, in
        their order, with the number of documents that hold each."""
        cuts = np.searchsorted(doc, doc[::CHUNK]) if len(doc) else doc  # where a document starts
        codes, counts = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        for i, j in zip(cuts, [*cuts[1:], len(doc)], strict=True):
            held = distinct(doc[i:j] * len(self.n_a) + word[i:j])
            w = held % max(1, len(self.n_a))
            times = np.diff(self.from_)[w]
            nth = np.arange(times.sum()) + np.repeat(self.from_[w] - np.cumsum(times) + times, times)
            held = distinct((self.codes[nth] << DOC_BITS) | np.repeat(held // max(1, len(self.n_a)), times))
            found = runs(held >> DOC_BITS)
            codes.append(found[0])
            counts.append(found[1])
        every, at = np.unique(np.concatenate(codes), return_inverse=True)
        total = np.zeros(len(every), dtype=np.int64)
        np.add.at(total, at, np.concatenate(counts))
        return every, total

    def texts(self, parts_of: list[str]) -> list[str]:
        """Each word's groups as ``a1,a2|b1;a3|b2``. ``parts_of``: the decimal
        ids followed by ',', then by '|', then by ';'."""
        n_ids, n = len(parts_of) // 3, len(self.a) + len(self.b)
        a_at = np.arange(len(self.a)) + (np.cumsum(self.b_in) - self.b_in)[self.a_group]
        b_at = np.arange(len(self.b)) + np.cumsum(self.a_in)[self.b_group]
        label = np.empty(n, dtype=np.int64)
        label[a_at], label[b_at] = self.a, self.b
        sizes = self.a_in + self.b_in
        end = np.cumsum(sizes)
        label[end - self.b_in - 1] += n_ids  # the last A token of a group
        label[end - 1] += 2 * n_ids
        parts = list(map(parts_of.__getitem__, label.tolist()))
        stop = np.cumsum(self.n_a + self.n_b).tolist()
        return ["".join(parts[i:j])[:-1] for i, j in zip([0, *stop], stop)]


@lru_cache(maxsize=1)
def labels(n_ids: int) -> list[str]:
    return [f"{i}{mark}" for mark in ",|;" for i in range(n_ids)]


def _sums(values: np.ndarray, from_: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(values)])[from_])


def block_rows(both: TwoTokenizers, block: int, ids: list, texts: list[str | None], slices: int) -> list[tuple]:
    """(block, slice, n, payload) rows of a block of documents: one with slice
    -1 for the documents, one for each slice that they have pairs in."""
    words = [both.words(t) if t else [] for t in texts]
    per_doc = np.array(list(map(len, words)), dtype=np.int64)
    flat = list(chain.from_iterable(words))
    numbers = {w: i for i, w in enumerate(dict.fromkeys(flat))}
    word = np.fromiter(map(numbers.__getitem__, flat), np.int64, len(flat))
    del words, flat
    doc = np.repeat(np.arange(len(per_doc)), per_doc)
    sides = both.cut(both.learn(list(numbers))) if numbers else [(np.zeros(0, dtype=np.int64),) * 2] * 2
    bad = sides[0][1] == 0
    if bad.any():
        lost = np.zeros(len(per_doc), dtype=bool)
        lost[doc[bad[word]]] = True
        word, doc = word[~lost[doc]], doc[~lost[doc]]
        per_doc[lost] = 0
    known = np.array([i is not None for i in ids], dtype=bool)
    rows = [(block, -1, len(ids), pack(np.array([i or 0 for i in ids]), known, per_doc, word, *sides[0], *sides[1]))]
    aligned = Aligned(*sides[0], *sides[1], both.a_lengths, both.b_lengths)
    codes, held = aligned.doc_pairs(word, doc)
    in_slice = (mixed(codes, slices) % np.uint64(slices)).astype(np.int64)
    order = np.argsort(in_slice, kind="stable")
    ends = np.cumsum(np.bincount(in_slice, minlength=slices)).tolist()
    for s, (i, j) in enumerate(zip([0, *ends], ends)):
        if j > i:
            rows.append((block, s, j - i, pack(np.diff(codes[order[i:j]], prepend=0), held[order[i:j]])))
    return rows


def read_blocks(docs: DataFrame, both: TwoTokenizers, slices: int, block_bytes: int) -> DataFrame:
    """Per block a row of kind ``docs`` and, per slice that it has pairs in, a
    row of kind ``pairs``; ``n`` counts documents or pairs."""

    # a broadcast is read once per worker, and its tokenizers built once
    shipped = docs.sparkSession.sparkContext.broadcast(both)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both = shipped.value
        block = TaskContext.get().partitionId() << 32
        ids: list = []
        texts: list[str | None] = []
        size = 0

        def frame() -> pd.DataFrame:
            nonlocal ids, texts, size, block
            rows = block_rows(both, block, ids, texts, slices)
            ids, texts, size, block = [], [], 0, block + 1
            return pd.DataFrame(rows, columns=["block", "slice", "n", "payload"])

        for batch in batches:
            for i, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids.append(None if pd.isna(i) else int(i))
                texts.append(text)
                size += len(text) if text else 0
                if size >= block_bytes or len(ids) >= 1 << DOC_BITS:
                    yield frame()
        if ids:
            yield frame()
        both.forget()
        give_back()

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = src.mapInPandas(run, "block long, slice int, n long, payload binary")
    kind = F.when(F.col("slice") < 0, F.lit("docs")).otherwise(F.lit("pairs"))
    return write_stage_table(found.withColumn("kind", kind), "aligned-blocks", ["kind"])


def _group(groups: int):
    return F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int")


def _pairs_of(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, held = unpack(payload)
    return np.cumsum(steps), held


def _tree(df: DataFrame, groups: int, fan_in: int, merge, schema: str, least: int = 1) -> DataFrame:
    """Merge the rows of a slice, ``fan_in`` groups at a time, to ``least`` rows
    or fewer."""
    while groups > least:
        groups = -(-groups // fan_in)
        df = df.withColumn("grp", F.pmod("grp", F.lit(groups)).cast("int")) \
               .groupBy("slice", "grp").applyInPandas(merge, schema)
    return df


def perfect_hashes(pairs: DataFrame, groups: int, fan_in: int) -> DataFrame:
    """Per slice the hash of its distinct pairs and the pairs in hash order."""
    schema = "slice int, grp int, n long, payload binary"

    def united(rows: pd.DataFrame) -> pd.DataFrame:
        keys = np.unique(np.concatenate([np.cumsum(unpack(p)[0]) for p in rows["payload"]]))
        return pd.DataFrame({"slice": [rows["slice"].iloc[0]], "grp": [rows["grp"].iloc[0]], "n": [len(keys)],
                             "payload": [pack(np.diff(keys, prepend=0))]})

    def hashed(rows: pd.DataFrame) -> pd.DataFrame:
        keys = np.unique(np.concatenate([np.cumsum(unpack(p)[0]) for p in rows["payload"]]))
        hash_ = PerfectHash.of(keys)
        in_order = np.empty_like(keys)
        in_order[hash_(keys)] = keys
        return pd.DataFrame({"slice": [rows["slice"].iloc[0]], "n": [len(keys)], "hash": [hash_.dump()], "keys": [pack(in_order)]})

    df = pairs.withColumn("grp", _group(groups))
    if groups > 1:
        df = _tree(df.groupBy("slice", "grp").applyInPandas(united, schema), groups, fan_in, united, schema, least=fan_in)
    return df.groupBy("slice").applyInPandas(hashed, "slice int, n long, hash binary, keys binary")


def _spread(per_slice: DataFrame, groups: int) -> DataFrame:
    return per_slice.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))


def _index(hash_: PerfectHash, keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Indices of pairs, verified against the keys in hash order."""
    at = hash_(wanted)
    if (at < 0).any() or (keys[at] != wanted).any():
        raise ValueError("a pair is missing from its slice")
    return at


def pair_counts(pairs: DataFrame, hashes: DataFrame, groups: int, fan_in: int) -> DataFrame:
    """Per slice its hash, keys and the corpus-wide counts, both in hash order."""
    schema = "slice int, grp int, payload binary"

    def dense(rows: pd.DataFrame, hashed: pd.DataFrame) -> pd.DataFrame:
        if rows.empty:
            return pd.DataFrame({"slice": [], "grp": [], "payload": []})
        hash_, (keys,) = PerfectHash.load(hashed["hash"].iloc[0]), unpack(hashed["keys"].iloc[0])
        vector = np.zeros(len(keys), dtype=np.int64)
        for payload in rows["payload"]:
            wanted, held = _pairs_of(payload)
            vector[_index(hash_, keys, wanted)] += held  # pairs of a block are distinct
        return pd.DataFrame({"slice": [rows["slice"].iloc[0]], "grp": [rows["grp"].iloc[0]], "payload": [pack(vector)]})

    def summed(rows: pd.DataFrame) -> pd.DataFrame:
        total = 0
        for payload in rows["payload"]:
            total = total + unpack(payload)[0]
        return pd.DataFrame({"slice": [rows["slice"].iloc[0]], "grp": [rows["grp"].iloc[0]], "payload": [pack(total)]})

    first = (pairs.withColumn("grp", _group(groups)).groupBy("slice", "grp")
                  .cogroup(_spread(hashes, groups).groupBy("slice", "grp")).applyInPandas(dense, schema))
    vectors = _tree(first, groups, fan_in, summed, schema)
    return hashes.join(vectors.select("slice", F.col("payload").alias("counts")), "slice")


def highest_counts(table: DataFrame, n_a: int, n_b: int) -> np.ndarray:
    """Of each A id the highest count among its pairs: at most |A| rows reach
    the driver."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = np.zeros(n_a, dtype=np.int64)
        for rows in batches:
            for keys, counts in zip(rows["keys"], rows["counts"], strict=True):
                np.maximum.at(best, unpack(keys)[0] // n_b, unpack(counts)[0])
        at = np.flatnonzero(best)
        yield pd.DataFrame({"a": at, "best": best[at]})

    best = np.zeros(n_a, dtype=np.int64)
    for r in table.mapInPandas(run, "a long, best long").groupBy("a").agg(F.max("best").alias("best")).collect():
        best[r["a"]] = r["best"]
    return best


def align_documents(docs: DataFrame, a_path: str, b_path: str, slices: int = 128, block_bytes: int = 1 << 20,
                    keys_per_group: int = 1 << 17, fan_in: int = 16) -> DataFrame:
    """Per document its groups as text and, over its links, their number, how
    many have their A id's highest count and the sum of their counts."""
    both = TwoTokenizers(a_path, b_path)
    n_a, n_b, lengths = len(both.a_bytes), len(both.b_bytes), (both.a_lengths, both.b_lengths)
    blocks = read_blocks(docs, both, slices, block_bytes)
    pairs = blocks.where("kind = 'pairs'").select("block", "slice", "n", "payload")
    total = pairs.agg(F.sum("n")).first()[0] or 0
    groups = -(-total // (slices * keys_per_group)) or 1
    hashes = stage(perfect_hashes(pairs, groups, fan_in), "pair-hashes")
    largest = hashes.agg(F.max("n")).first()[0] or 0
    groups = -(-total // (slices * max(keys_per_group, 4 * largest))) or 1
    table = stage(pair_counts(pairs, hashes, groups, fan_in), "pair-counts")
    best = highest_counts(table, n_a, n_b)

    def look_up(rows: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if rows.empty:
            return pd.DataFrame({"block": [], "payload": []})
        hash_, (keys,), (counts,) = (PerfectHash.load(held["hash"].iloc[0]), unpack(held["keys"].iloc[0]),
                                     unpack(held["counts"].iloc[0]))
        out = []
        for payload in rows["payload"]:
            wanted, _ = _pairs_of(payload)
            out.append(pack(np.diff(wanted, prepend=0), counts[_index(hash_, keys, wanted)]))
        return pd.DataFrame({"block": rows["block"], "payload": out})

    answers = (pairs.withColumn("grp", _group(groups)).groupBy("slice", "grp")
                    .cogroup(_spread(table, groups).groupBy("slice", "grp"))
                    .applyInPandas(look_up, "block long, payload binary"))

    def weigh(rows: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        ids, known, per_doc, word, a, in_a, b, in_b = unpack(rows["payload"].iloc[0])
        aligned = Aligned(a, in_a, b, in_b, *lengths)
        got = [_pairs_of(p) for p in found["payload"]]
        keys = np.concatenate([np.zeros(0, dtype=np.int64), *(g[0] for g in got)])
        counts = np.concatenate([np.zeros(0, dtype=np.int64), *(g[1] for g in got)])
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        # a word of unusable documents alone has no count and is used by none
        at = np.minimum(np.searchsorted(keys, aligned.codes), max(0, len(keys) - 1))
        count = np.where(keys[at] == aligned.codes, counts[at], 0) if len(keys) else np.zeros(len(aligned.codes), int)
        is_best = count == best[aligned.codes // n_b]
        from_ = np.concatenate([[0], np.cumsum(per_doc)])

        def per_document(values: np.ndarray) -> np.ndarray:
            return _sums(values[word], from_)

        texts = aligned.texts(labels(max(n_a, n_b)))
        whole = list(map(texts.__getitem__, word.tolist()))
        ends = from_.tolist()
        give_back()  # beside the executor's heap there is little room
        return pd.DataFrame({
            "doc_id": pd.array(ids, dtype="Int64").copy() if known.all() else pd.array(
                [i if k else None for i, k in zip(ids.tolist(), known.tolist(), strict=True)], dtype="Int64"),
            "n_a": per_document(in_a), "n_b": per_document(in_b), "n_groups": per_document(aligned.n_groups),
            "n_links": per_document(aligned.n_links),
            "n_best": per_document(_sums(aligned.weights * is_best, aligned.from_)),
            "count_sum": per_document(_sums(aligned.weights * count, aligned.from_)),
            "groups": [";".join(whole[i:j]) for i, j in zip(ends, ends[1:])]})

    return (blocks.where("kind = 'docs'").select("block", "payload").groupBy("block")
                  .cogroup(answers.groupBy("block")).applyInPandas(weigh, RESULT))
