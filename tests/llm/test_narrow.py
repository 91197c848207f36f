"""Packing, quality rules and importance resampling."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from txnrisk.llm import queries as Q
from txnrisk.llm.boosting import fit
from txnrisk.llm.bytewords import chunks
from txnrisk.llm.importance import resample
from txnrisk.llm.packing import fill_bins, pack_documents
from txnrisk.llm.quality_rules import judge_documents, keep_good

ODD = [(1, None, "a"), (2, "", None), (3, " \t\n", "a"), (4, "one", "a"), (4, "one", "a"), (None, "x <|endoftext|> y", "b"),
       (6, "word " * 30_000, "b"), (7, "z" * 5000, "b"), (8, "Ünïcödé — 漢字 🙂", "c")]


def reference_ids(text):
    import public_tokenizers
    from tokenizers import Tokenizer
    global _T
    try:
        t = _T
    except NameError:
        t = _T = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")


def check_pieces(rows, texts, length=1024):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for doc, text in texts.items():
        ids = reference_ids(text)
        at = 0
        for r in sorted(by_doc[doc], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert bytes(r.ids) == ids[at:at + r.length].tobytes()
            at += r.length
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= length
    return by_sequence


def test_packing_round_trip(small):
    df, texts = small
    rows = pack_documents(df, Q.tokenizer_path()).collect()
    sequences = check_pieces(rows, dict(texts))
    used = sum(r.length for r in rows)
    assert used > 0.95 * 1024 * len(sequences)


def test_packing_odd_texts(docs_of):
    rows = pack_documents(docs_of(ODD), Q.tokenizer_path()).collect()
    check_pieces([r for r in rows if r.doc_id != 4], {i: t for i, t, _ in ODD if i != 4})
    assert len([r for r in rows if r.doc_id == 4]) == 2  # repeated rows are packed both


def test_packing_limits(docs_of):
    docs = docs_of([(i, f"some words {i}", "a") for i in range(60)])
    rows = pack_documents(docs, Q.tokenizer_path(), length=64, max_segments=3, max_loss_tokens=20, min_cut=4).collect()
    for own in check_pieces(rows, {i: f"some words {i}" for i in range(60)}, 64).values():
        assert len(own) <= 3 and sum(r.loss_tokens for r in own) <= 20


def test_fill_bins_prefers_large_dot_product():
    bins = fill_bins(np.array([10, 90, 30, 60]), np.array([9, 89, 29, 59]), (100, 8, 100), 32)
    assert bins[0] == [(1, 0, 90), (0, 0, 10)] and bins[1] == [(3, 0, 60), (2, 0, 30)]


def test_packing_query_digest(spark):
    got = Q.QUERIES["op1_packing"](spark, "/root/testdata/sf0.001").first()
    text = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where(f"doc_id = {got.doc_id}").first().text
    piece = reference_ids(text)[got.start:got.start + got.length]
    assert got.ids_crc32 == zlib.crc32(piece.tobytes())


def brute_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[k:k + 8]) for k in range(len(words) - 7))
    again = {p for k in range(len(words) - 7) if windows[tuple(words[k:k + 8])] > 1 for p in range(k, k + 8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(again))


def stats_of(rows):
    return {(r.doc_id): tuple(r.s[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) for r in rows}


def test_statistics_against_brute_force(spark, small, docs_of):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    df, texts = small
    judged = judge_documents(df, labels).collect()
    assert stats_of(judged) == {i: brute_statistics(t) for i, t in texts}
    for r in judged:
        failed = r.s.n_words < 20 or 100 * r.s.n_repeat_words > 30 * r.s.n_words
        assert r.base_failed == failed and not (failed and r.kept)
    odd = judge_documents(docs_of(ODD), labels).collect()
    assert stats_of(odd) == {i: brute_statistics(t) for i, t, _ in ODD} and len(odd) == len(ODD)


def test_chunks_bound_and_order():
    texts = ["a b"] * 3 + ["w " * 1_200_000] + [None, "c"]
    got = list(chunks(texts))
    assert sum(c.n for c in got) == 6 and len(got) > 1
    assert np.concatenate([c.per_doc(c.word_doc) for c in got]).tolist() == [2, 2, 2, 1_200_000, 0, 1]


def test_quality_separates_held_out(spark):
    """Trained on half of the labels, judged on the other half."""
    from pyspark.sql import functions as F
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    half = labels.where(F.xxhash64("doc_id") % 2 == 0)
    test = judge_documents(docs, half).where("not base_failed").join(labels.where(F.xxhash64("doc_id") % 2 != 0), "doc_id").toPandas()
    assert test.loc[test.quality == 1, "kept"].mean() > 0.97
    assert test.loc[test.quality == 0, "kept"].mean() < 0.1


def test_quality_without_labels_and_with_other_columns(spark, docs_of):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    good = " ".join(f"w{k}" for k in range(40))
    docs = docs_of([(1, good, "a"), (2, "short", "a"), (3, None, None)]).selectExpr("*", "1 as s", "2 as kept", "3 as row")
    assert [r.doc_id for r in keep_good(docs, labels).collect()] == [1]
    assert keep_good(docs, labels).columns == docs.columns
    assert keep_good(docs.limit(0), labels).collect() == []


def test_boosting_is_monotone():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 3))
    y = ((x[:, 0] + 0.3 * rng.standard_normal(2000) < 0.5) ^ (x[:, 1] > 0.9)).astype(float)
    model = fit(x, y, np.array([-1, 0, 0]))
    grid = np.repeat(rng.random((50, 3)), 30, axis=0)
    grid[:, 0] = np.tile(np.linspace(0, 1, 30), 50)
    score = model.score(grid).reshape(50, 30)
    assert (np.diff(score, axis=1) <= 1e-9).all()
    assert ((model.score(x) > 0) == (y > 0)).mean() > 0.75


def test_boosting_constant_for_one_class():
    assert fit(np.ones((5, 2)), np.ones(5), np.zeros(2)).score(np.zeros((2, 2))).min() > 5


def test_resampling_size_order_and_target(spark, small):
    df, _ = small
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    got = resample(df, labels, target="quality = 1", share=0.5).toPandas()
    assert len(got) == round(0.5 * df.count())
    again = resample(df.repartition(7), labels, target="quality = 1", share=0.5).toPandas()
    assert set(got.doc_id) == set(again.doc_id)
    joined = got.merge(labels.toPandas(), on="doc_id")
    assert joined.quality.mean() > 0.9


@pytest.mark.parametrize("share", [0.0, 1.0])
def test_resampling_odd_texts(spark, docs_of, share):
    labels = spark.createDataFrame([(4, 1, 0), (None, 1, 0), (99, 0, 0)], "doc_id long, quality int, toxic int")
    got = resample(docs_of(ODD), labels, target="quality = 1", share=share).collect()
    assert len(got) == round(share * len(ODD))
    none = resample(docs_of(ODD), labels.limit(0), target="quality = 1").collect()
    assert len(none) == len(ODD) and all(abs(r.log_weight) < 1e-9 for r in none)
