"""N-gram Jaccard join with several global token orders.

A document is the set of its distinct word n-grams (words lower-cased in A-Z);
with fewer words its whole word sequence is one token, without words the set
is empty and joins nothing. Two documents are linked if their Jaccard
similarity is at least ``percent`` / 100, exactly.

A linked pair overlaps in at least ceil(percent * n / 100) tokens of either
set, so under any global token order it shares a token among the first
n - ceil(percent * n / 100) + 1 of both. All orders here sort by document
frequency first and by a hash of their own second. Tokens of one document only
come first and match nothing: a document whose prefix holds no other token is
done, which leaves few. The others are posted under their prefix tokens in the
first order, with the place: a pair of sets of x and y tokens must overlap in a
= ceil(percent / (100 + percent) * (x + y)), so it meets under a token among the
first x - a + 1 and y - a + 1. A pair that meets must also agree enough in a histogram of its
tokens (the smaller counts bound the overlap from above) and share a prefix
token in every further order before its sets are intersected.

Document frequencies come from one pass over all texts: tasks cut the token
hashes into buckets and ship them as packed arrays, a bucket counts its tokens
and sends those of several documents back to their chunk, with counts. Equal
sets are one class and ``linked_groups`` avoids all pairs of a bucket.

Null text counts as empty. Repeated rows fall into one class. A null id can
belong to a group but never names it (unless all its ids are null).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytewords import Hasher, chunks, give_back, mix, ngrams
from .common import perhaps_in, stage
from .components import linked_groups

ORDERS = 3
CELLS = 32  # of the histogram of a document's tokens
TOKENS_HELD = 500_000  # per task, before they are sent off
BUCKETS_PER_PARTITION = 4  # of the shuffle; a bucket is what a task holds at once
_U = np.uint64


def token_sets(texts, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per chunk: set sizes, and all tokens, document by document, ascending."""
    for c in chunks(texts, lower=True):
        word = Hasher(c.buf)(c.word_start, c.word_end)
        gram = ngrams(word, n)
        whole = np.flatnonzero(c.word_doc[:len(gram)] == c.word_doc[len(c.word_doc) - len(gram):])
        words = c.per_doc(c.word_doc)
        first = np.concatenate(([0], np.cumsum(words)[:-1]))
        short = np.flatnonzero((words > 0) & (words < n))
        lone = np.zeros(len(short), dtype=np.uint64)
        for j in range(n - 1):  # all words, folded with their number
            has = words[short] > j
            lone[has] = mix(lone[has] + word[first[short[has]] + j] + _U(j + 1))
        doc = np.concatenate((c.word_doc[whole], short))
        token = np.concatenate((gram[whole], lone))
        order = np.lexsort((token, doc))
        doc, token = doc[order], token[order]
        new = np.ones(len(doc), dtype=bool)
        new[1:] = (doc[1:] != doc[:-1]) | (token[1:] != token[:-1])
        yield c.per_doc(doc[new]), token[new]


def _signatures(size: np.ndarray, token: np.ndarray) -> list[np.ndarray]:
    doc = np.repeat(np.arange(len(size)), size)
    out = []
    for salt in (1, 2):
        total = np.zeros(len(size), dtype=np.uint64)
        np.add.at(total, doc, mix(token + _U(salt)))
        out.append(total.view(np.int64))
    return out


def _sent(src: DataFrame, n: int, buckets: int) -> DataFrame:
    """(bucket, chunk, kind, blob): per chunk of documents and bucket, how many
    tokens each document has there, and the tokens (32 bits beside the bucket's
    share of the hash); and a row of kind 0 with ids, sizes and signatures."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get().partitionId()
        ids: list = []
        sizes: list[np.ndarray] = []
        tokens: list[np.ndarray] = []
        held = count = 0

        def send() -> pd.DataFrame:
            nonlocal ids, sizes, tokens, held, count
            chunk = task << 32 | count
            size, token = np.concatenate(sizes), np.concatenate(tokens)
            a, b = _signatures(size, token)
            known = np.array([x is not None for x in ids])
            number = np.array([x or 0 for x in ids], dtype=np.int64)
            meta = b"".join(x.astype("<i8").tobytes() for x in (known, number, size, a, b))
            bucket = (token % _U(buckets)).astype(np.int64)
            doc = np.repeat(np.arange(len(size)), size)
            order = np.argsort(bucket, kind="stable")
            cell = np.bincount(doc * CELLS + (mix(token) % _U(CELLS)).astype(np.int64), minlength=len(size) * CELLS)
            meta += cell.astype("<i8").tobytes()
            rest = (token[order] // _U(buckets)).astype("<u4")
            edge = np.searchsorted(bucket[order], np.arange(buckets + 1))
            rows = [(int(chunk % buckets), chunk, 0, meta)]
            for k in range(buckets):
                part = slice(edge[k], edge[k + 1])
                if edge[k] < edge[k + 1]:
                    per = np.bincount(doc[order[part]], minlength=len(size)).astype("<u4")
                    rows.append((k, chunk, 1, np.uint32(len(size)).tobytes() + per.tobytes() + rest[part].tobytes()))
            ids, sizes, tokens, held = [], [], [], 0
            count += 1
            return pd.DataFrame(rows, columns=["bucket", "chunk", "kind", "blob"])

        for batch in batches:
            known = [None if pd.isna(x) else int(x) for x in batch["doc_id"]]
            at = 0
            for size, token in token_sets(batch["text"], n):
                ids += known[at:at + len(size)]
                at += len(size)
                sizes.append(size)
                tokens.append(token)
                held += len(token) + len(size)
                if held >= TOKENS_HELD:
                    yield send()
        if ids:
            yield send()
        give_back()

    return src.mapInPandas(run, "bucket int, chunk long, kind int, blob binary")


def _counted(sent: DataFrame) -> DataFrame:
    """Back to the chunks: the tokens of several documents, with their number
    of documents; the rows of kind 0 as they are."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out = [tuple(x) for x in rows.loc[rows["kind"] == 0, ["bucket", "chunk", "kind", "blob"]].itertuples(index=False)]
        mine = rows[rows["kind"] == 1]
        parts = []
        for blob in mine["blob"]:
            docs = int(np.frombuffer(blob, "<u4", 1)[0])
            parts.append((np.frombuffer(blob, "<u4", docs, 4), np.frombuffer(blob, "<u4", -1, 4 + 4 * docs)))
        if parts:
            token = np.concatenate([t for _, t in parts])
            _, at, n = np.unique(token, return_inverse=True, return_counts=True)
            n = n[at]
            start = 0
            for chunk, bucket, (per, own) in zip(mine["chunk"], mine["bucket"], parts, strict=True):
                df = n[start:start + len(own)]
                start += len(own)
                shared = df > 1
                doc = np.repeat(np.arange(len(per)), per)[shared]
                if len(doc):
                    left = np.bincount(doc, minlength=len(per)).astype("<u4")
                    out.append((bucket, chunk, 1, left.tobytes() + own[shared].tobytes()
                                + np.minimum(df[shared], 2 ** 32 - 1).astype("<u4").tobytes()))
        give_back()
        return pd.DataFrame(out, columns=["bucket", "chunk", "kind", "blob"])

    return sent.groupBy("bucket").applyInPandas(run, "bucket int, chunk long, kind int, blob binary")


def _assembled(counted: DataFrame, buckets: int, percent: int) -> DataFrame:
    """One row per document: (doc_id, n, s1, s2, order, rare, cells, tokens,
    prefix1 ..); the arrays only where a prefix holds a token of several documents.
    ``order``: the less, the more common its tokens are on the whole; what
    copies were made of comes before the copies."""
    names = ["doc_id", "n", "s1", "s2", "order", "rare", "cells", "tokens", *[f"prefix{k}" for k in range(1, ORDERS + 1)]]
    schema = "doc_id long, n long, s1 long, s2 long, order long, rare long, " + ", ".join(
        f"{x} array<long>" for x in names[6:])

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        meta = np.frombuffer(rows.loc[rows["kind"] == 0, "blob"].iloc[0], "<i8")
        known, ids, size, s1, s2 = meta[:5 * len(meta) // (5 + CELLS)].reshape(5, -1)
        cells = meta[5 * len(ids):].reshape(-1, CELLS)
        docs, tokens, dfs = [], [], []
        for bucket, blob in rows.loc[rows["kind"] == 1, ["bucket", "blob"]].itertuples(index=False):
            per = np.frombuffer(blob, "<u4", len(ids))
            rest = np.frombuffer(blob, "<u4", -1, 4 * len(ids)).reshape(2, -1)
            docs.append(np.repeat(np.arange(len(ids)), per))
            tokens.append(rest[0].astype(np.uint64) * _U(buckets) + _U(bucket))
            dfs.append(rest[1])
        doc = np.concatenate(docs) if docs else np.zeros(0, np.int64)
        token = np.concatenate(tokens) if docs else np.zeros(0, np.uint64)
        df = np.concatenate(dfs) if docs else np.zeros(0, np.uint32)
        shared = np.bincount(doc, minlength=len(ids))
        rare = size - shared
        common = np.bincount(doc, np.log2(df), minlength=len(ids)) / np.maximum(size, 1)
        prefix = size - (percent * size + 99) // 100 + 1 - rare  # tokens of several documents in it
        open_ = (prefix > 0) & (shared > 0)
        use = open_[doc]
        doc, token, df = doc[use], token[use], df[use]
        n_open = np.bincount(doc, minlength=len(ids))
        end = np.cumsum(n_open)
        out = pd.DataFrame({"doc_id": pd.array(np.where(known > 0, ids, 0), dtype="Int64"), "n": size, "s1": s1, "s2": s2,
                            "order": (-1000 * common).astype(np.int64), "rare": rare})
        out.loc[known == 0, "doc_id"] = pd.NA
        columns: dict[str, list] = {x: [None] * len(ids) for x in names[6:]}
        for k in range(1, ORDERS + 1):
            order = np.lexsort((mix(token + _U(k)), df, doc))
            by = token[order].view(np.int64)
            for d in np.flatnonzero(open_):
                mine = by[end[d] - n_open[d]:end[d]]
                columns[f"prefix{k}"][d] = mine[:prefix[d]]
                if k == 1:
                    columns["tokens"][d], columns["cells"][d] = mine, cells[d]
        give_back()
        return out.assign(**columns)[names]

    return counted.groupBy("chunk").applyInPandas(run, schema)


def jaccard_groups(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
                   ) -> DataFrame:
    """(doc_id, n_shingles, component_id, links) for every row of ``docs``;
    ``links``: whether the row's group has another row. component_id is the
    smallest doc_id that its links reach."""
    spark = docs.sparkSession
    buckets = BUCKETS_PER_PARTITION * max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    rows = stage(_assembled(_counted(_sent(src, n, buckets)), buckets, percent), "jaccard-sets")
    same = ["n", "s1", "s2"]
    classes = rows.groupBy(*same).agg(F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("n_rows"),
                                      F.min("order").alias("order"))
    # written once, so that the ids stay
    classes = stage(classes.withColumn("id", F.monotonically_increasing_id()), "jaccard-classes")
    # one row of each class that may have partners, with its sets
    sets = stage(rows.where("tokens is not null").dropDuplicates(same).drop("doc_id", "order")
                 .join(classes, same), "jaccard-open")
    posted = sets.select("id", "n", "order", "rare", "cells", F.posexplode("prefix1").alias("at", "key"))
    postings = posted.select("key", F.struct("id", "n", "order", "cells", (F.col("rare") + F.col("at")).alias("place")).alias("item"))

    def overlap(x: Column, y: Column) -> Column:
        """How many tokens linked sets of these sizes share at least."""
        return F.ceil(F.lit(percent) * (x + y) / F.lit(100 + percent) - 1e-9)

    def near(x: Column, y: Column) -> Column:
        least = overlap(x["n"], y["n"])
        early = (x["place"] <= x["n"] - least) & (y["place"] <= y["n"] - least)
        most = F.aggregate(F.zip_with(x["cells"], y["cells"], lambda a, b: F.least(a, b)), F.lit(0).cast("long"),
                           lambda a, b: a + b)
        return early & (most >= least)

    def verify(pairs: DataFrame) -> DataFrame:
        further = [f"prefix{k}" for k in range(2, ORDERS + 1)]

        def side(name: str, columns: list[str]) -> DataFrame:
            return sets.select(F.col("id").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in columns])

        def prefix(name: str, column: str) -> Column:
            n = F.col(f"{name}_n") - overlap(F.col("a_n"), F.col("b_n")) + 1 - F.col(f"{name}_rare")
            return F.slice(f"{name}_{column}", F.lit(1), F.greatest(n, F.lit(0)).cast("int"))

        met = pairs.join(side("a", ["n", "rare", *further]), "a").join(side("b", ["n", "rare", *further]), "b")
        for c in further:
            met = met.where(F.arrays_overlap(prefix("a", c), prefix("b", c)))
        met = met.select("a", "b").join(side("a", ["tokens", "n"]), "a").join(side("b", ["tokens", "n"]), "b")
        both = F.size(F.array_intersect("a_tokens", "b_tokens")).cast("long")
        return met.withColumn("both", both).where(
            100 * F.col("both") >= percent * (F.col("a_n") + F.col("b_n") - F.col("both"))).select("a", "b")

    groups = linked_groups(postings, near, verify, "order")
    named = classes.join(groups, "id", "left").withColumn("component", F.coalesce("component", "id"))
    total = named.groupBy("component").agg(F.min("least_id").alias("component_id"), F.sum("n_rows").alias("n_group"))
    named = named.join(total, "component").select(*same, "component_id", "n_group")
    linked = rows.select("doc_id", *same).where("n > 0").join(named, same)
    out = linked.select("doc_id", F.col("n").alias("n_shingles"), "component_id", (F.col("n_group") > 1).alias("links"))
    alone = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"),
                                       F.lit(False).alias("links"))
    return out.unionByName(alone)


def keep_first(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group stays, with the smallest id; of several rows with
    that id, one. Rows with an empty set, or whose group has no id, all stay,
    and so do rows with a null id."""
    groups = stage(jaccard_groups(docs, n, percent, id_col, text_col), "jaccard-groups").where("links")
    id_ = F.col(f"`{id_col}`").cast("long")
    gone = groups.where("doc_id > component_id").select(F.col("doc_id").alias("_llm_id")).distinct()
    # rows that a bitmap of the ids rules out need no join (nor a shuffle)
    perhaps = F.coalesce(perhaps_in(gone, F.xxhash64("_llm_id"), F.xxhash64(id_)), F.lit(False))
    kept = docs.where(~perhaps).unionByName(docs.where(perhaps).join(gone, id_ == F.col("_llm_id"), "left_anti"))
    again = groups.where("doc_id = component_id").groupBy(F.col("doc_id").alias("_llm_id")).count().where("count > 1")
    if again.isEmpty():
        return kept
    again = again.select("_llm_id")
    return (kept.join(again, id_ == F.col("_llm_id"), "left_anti")
            .unionByName(kept.join(again, id_ == F.col("_llm_id"), "left_semi").dropDuplicates([id_col])))
