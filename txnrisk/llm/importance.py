"""Quality classifier by importance resampling.

Two generative models over hashed word 1- and 2-grams: one of the target (text
labelled good), one of the raw corpus (all documents). A document's importance
is the log ratio of its likelihoods under the two, and a sample of ``k`` is
drawn without replacement by Gumbel top-k: the k largest log ratios plus
Gumbel noise, the noise being a hash of the document.

The raw model counts every n-gram of every document; the target model may be
fitted on at most ``MOST_TARGET`` labelled documents (by hash order when there
are more). The models are two arrays of ``BUCKETS`` numbers. The k-th largest
key comes from a distributed rank, not from a sort in one task.

Documents without words have log ratio 0. Null ids, repeated rows and ties are
ordered by id and text hash; identical rows are interchangeable. With no target
labels both models are equal, and the sample is uniform.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import ordinal_rank
from .bytewords import Hasher, chunks, give_back, ngrams
from .common import stage, uniform

BUCKETS = 1 << 16
MOST_TARGET = 20_000
SEED = 11


def _grams(texts: pd.Series) -> Iterator[tuple]:
    """Per chunk: the chunk, and bucket and document of each 1- and 2-gram."""
    for c in chunks(texts, lower=True):
        word = Hasher(c.buf)(c.word_start, c.word_end)
        pair = ngrams(word, 2)
        inside = np.flatnonzero(c.word_doc[:len(pair)] == c.word_doc[len(c.word_doc) - len(pair):])
        key = np.concatenate((word, pair[inside]))
        doc = np.concatenate((c.word_doc, c.word_doc[inside]))
        yield c, (key % np.uint64(BUCKETS)).astype(np.int64), doc


def bucket_counts(texts: DataFrame, text_col: str = "text") -> np.ndarray:
    """How often each bucket occurs in all texts. Each task sums its own; the
    sums of tasks are added up by bucket."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for b in batches:
            for _, bucket, _ in _grams(b["text"]):
                total += np.bincount(bucket, minlength=BUCKETS)
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": seen, "n": total[seen]})
        give_back()

    src = texts.select(F.col(text_col).cast("string").alias("text"))
    rows = src.mapInPandas(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(BUCKETS)
    out[rows["bucket"].to_numpy(dtype=np.int64)] = rows["n"]
    return out


def log_ratio(target: np.ndarray, raw: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    """Per bucket: log of target over raw probability. The raw model is the
    prior of the target's, with ``smoothing`` pseudo-counts per bucket."""
    p = (raw + 1) / (raw + 1).sum()
    q = (target + smoothing * BUCKETS * p) / (target.sum() + smoothing * BUCKETS)
    return np.log(q) - np.log(p)


def score(docs: DataFrame, ratio: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
          per_gram: bool = True, scale: float = 50.0) -> DataFrame:
    """(doc_id, n_grams, log_weight). ``per_gram``: the mean over the n-grams
    times ``scale`` (a temperature), so that length alone decides nothing;
    otherwise the sum."""

    @F.pandas_udf("n_grams long, total double")
    def total(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            parts = [pd.DataFrame({"n_grams": c.per_doc(doc),
                                   "total": np.bincount(doc, ratio[bucket], minlength=c.n)})
                     for c, bucket, doc in _grams(texts)]
            yield pd.concat(parts, ignore_index=True) if parts else pd.DataFrame({"n_grams": [], "total": []})

    s = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"),
                    total(F.col(text_col).cast("string")).alias("s"))
    mean = F.lit(float(scale)) * F.col("s.total") / F.greatest("s.n_grams", F.lit(1))
    return s.select("doc_id", "text_hash", "s.n_grams", (mean if per_gram else F.col("s.total")).alias("log_weight"))


def resample(docs: DataFrame, labels: DataFrame, target: str, wanted: str | None = None,
             share: float | None = None, id_col: str = "doc_id",
             text_col: str = "text", most_target: int = MOST_TARGET, seed: int = SEED) -> DataFrame:
    """(doc_id, n_grams, log_weight, gumbel_key) of the sample. ``target``: the
    condition on ``labels`` that marks target documents. The sample's size is
    ``share`` of the rows, by default the share of labelled rows that meet
    ``wanted`` (or else ``target``)."""
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.expr(target).alias("good"),
                           F.expr(wanted or target).alias("wanted"))
    marked = marked.where("doc_id is not null and good is not null")
    good = marked.where("good").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_target)
    ids = docs.withColumn("_llm_id", F.col(f"`{id_col}`").cast("long"))
    chosen = ids.join(F.broadcast(good.withColumnRenamed("doc_id", "_llm_id")), "_llm_id", "left_semi")  # most_target ids
    fitted = bucket_counts(chosen, text_col)
    raw = bucket_counts(docs, text_col)
    if share is None:
        share = marked.agg(F.avg(F.col("wanted").cast("double"))).first()[0]
        share = 1.0 if share is None else share
    scored = score(docs, log_ratio(fitted, raw), id_col, text_col)
    noise = -F.log(-F.log(uniform(F.lit(seed), "doc_id", "text_hash")))
    keyed = stage(scored.withColumn("gumbel_key", F.col("log_weight") + noise), "resample-keys")
    k = round(share * keyed.count())
    order = [F.col("gumbel_key").desc(), F.col("doc_id").asc_nulls_last(), F.col("text_hash").asc()]
    return ordinal_rank(keyed, order, name="rank").where(F.col("rank") <= k).drop("rank", "text_hash")
