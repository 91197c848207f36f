"""Quality rules: boosted trees over document statistics.

The statistics of every whole text come from a vectorised pass (``bytewords``)
in a pandas UDF; nothing but their small struct leaves it. The trees are
fitted on at most ``MOST_LABELLED`` labelled rows (taken by hash order when
there are more; a documented bound on the driver's work), are flattened into
numpy arrays, and score all documents in a second pandas UDF. The score falls
monotonically with symbols, repeated lines and repeated words.

Null and empty texts have no words and fail the base rule. Without labels (or
with one class) the model is a constant and only the base rule rejects, unless
all labels are bad. Repeated rows are judged alike. Labels of unknown
documents and null labels are left out; several labels of one document count
as several examples.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .boosting import Forest, fit
from .bytewords import Hasher, chunks, give_back, ngrams, repeated
from .common import stage

MOST_LABELLED = 50_000
WINDOW = 8
SYMBOLS = b"#*$%&|<>"
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_bytes", "n_upper", "n_punct",
         "n_digits", "n_lines", "n_distinct_words"]
# Features of the model and the direction in which the score may go with them.
FEATURES = {"symbols": -1, "dup_lines": -1, "repeat_words": -1, "word_length": 0, "upper": 0, "punct": 0,
            "digits": 0, "line_words": 0, "distinct": 0, "log_words": 0}


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


_KINDS = {"n_symbols": _table(SYMBOLS), "n_upper": _table(bytes(range(65, 91))),
          "n_punct": _table(b"!?.,;:\"'()[]{}-_/\\^~`@+="), "n_digits": _table(b"0123456789")}


def text_statistics(texts: pd.Series) -> pd.DataFrame:
    """One row of ``STATS`` per text."""
    frames = []
    for c in chunks(texts):
        hasher = Hasher(c.buf)
        word = hasher(c.word_start, c.word_end)
        sums = {"n_words": c.per_doc(c.word_doc), "n_bytes": c.doc_end - c.doc_start}

        def between(mask: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
            total = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
            return total[end] - total[start]

        lead = (c.buf & 0xC0) != 0x80  # the first byte of a character
        sums["word_chars"] = np.bincount(c.word_doc, between(lead, c.word_start, c.word_end),
                                         minlength=c.n).astype(np.int64)
        for name, table in _KINDS.items():
            sums[name] = between(table[c.buf], c.doc_start, c.doc_end)
        line_end = np.flatnonzero(c.buf == 10)
        line_start = np.concatenate(([0], line_end[:-1] + 1))
        line_doc = np.searchsorted(c.doc_end, line_start)
        starts = np.zeros(len(c.buf) + 1, dtype=bool)
        starts[c.word_start] = True
        wordy = between(starts[:-1], line_start, line_end) > 0
        _, later = repeated(line_doc[wordy], hasher(line_start[wordy], line_end[wordy]))
        sums["n_dup_lines"] = c.per_doc(line_doc[wordy][later])
        sums["n_lines"] = c.per_doc(line_doc[wordy])
        gram = ngrams(word, WINDOW)
        inside = c.word_doc[:len(gram)] == c.word_doc[WINDOW - 1:] if len(gram) else np.zeros(0, dtype=bool)
        at = np.flatnonzero(inside)
        again, _ = repeated(c.word_doc[at], gram[at])
        cover = np.zeros(len(word) + 1, dtype=np.int64)
        np.add.at(cover, at[again], 1)
        np.add.at(cover, at[again] + WINDOW, -1)
        sums["n_repeat_words"] = c.per_doc(c.word_doc[np.cumsum(cover[:-1]) > 0])
        _, later = repeated(c.word_doc, word)
        sums["n_distinct_words"] = c.per_doc(c.word_doc[~later])
        frames.append(pd.DataFrame(sums))
    empty = pd.DataFrame({n: pd.Series(dtype="int64") for n in STATS})
    return pd.concat(frames, ignore_index=True)[STATS] if frames else empty


@F.pandas_udf(T.StructType([T.StructField(n, T.LongType()) for n in STATS]))
def statistics(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        yield text_statistics(texts)
    give_back()


def features(s: pd.DataFrame) -> np.ndarray:
    words, lines = np.maximum(s["n_words"], 1), np.maximum(s["n_lines"], 1)
    chars, size = np.maximum(s["word_chars"], 1), np.maximum(s["n_bytes"], 1)
    return np.stack([s["n_symbols"] / chars, s["n_dup_lines"] / lines, s["n_repeat_words"] / words,
                     s["word_chars"] / words, s["n_upper"] / size, s["n_punct"] / words, s["n_digits"] / size,
                     s["n_words"] / lines, s["n_distinct_words"] / words, np.log1p(s["n_words"])], axis=1)


def base_failed(s: str = "s") -> Column:
    words = F.col(f"{s}.n_words")
    return (words < 20) | (100 * F.col(f"{s}.n_repeat_words") > 30 * words)


def train(stats: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Forest:
    """``stats``: (doc_id, s); ``labels``: (doc_id, quality). Rows that fail
    the base rule don't need the model and are left out."""
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    rows = (stats.where(~base_failed()).join(marked.where("quality in (0, 1)"), "doc_id")
            .orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(most)
            .select("s.*", "quality").toPandas())
    return fit(features(rows), rows["quality"].to_numpy(dtype=float), np.array(list(FEATURES.values())))


def accepted(model: Forest, threshold: float = 0.5, s: str = "s") -> Column:
    """The model's verdict: probability of good quality at least ``threshold``."""
    least = float(np.log(threshold / (1 - threshold)))

    @F.pandas_udf("boolean")
    def judge(stats: pd.DataFrame) -> pd.Series:
        return pd.Series(model.score(features(stats)) >= least)

    return judge(F.col(s))


def keeps(model: Forest, threshold: float = 0.5):
    """A UDF on texts: whether a document passes the base rule and the trees."""
    least = float(np.log(threshold / (1 - threshold)))

    @F.pandas_udf("boolean")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            s = text_statistics(texts)
            failed = (s["n_words"] < 20) | (100 * s["n_repeat_words"] > 30 * s["n_words"])
            yield pd.Series(~failed.to_numpy() & (model.score(features(s)) >= least))
        give_back()

    return judge


def document_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       statistics(F.col(text_col).cast("string")).alias("s"))


def judge_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, s, base_failed, kept) for every row of ``docs``."""
    stats = stage(document_stats(docs, id_col, text_col), "quality-stats")
    model = train(stats, labels)
    return stats.select("doc_id", "s", base_failed().alias("base_failed"), accepted(model).alias("ok")).select(
        "doc_id", "s", "base_failed", (~F.col("base_failed") & F.col("ok")).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns. The texts
    are read twice, to fit and to judge, and never shuffled."""
    model = train(stage(document_stats(docs, id_col, text_col), "quality-stats"), labels)
    return docs.where(keeps(model)(F.col(f"`{text_col}`").cast("string")))
