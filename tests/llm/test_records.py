"""WARC archives and preference pairs."""

import gzip
import hashlib

import duckdb
import pytest

from txnrisk.llm import queries as Q
from txnrisk.llm import warc as W
from txnrisk.llm.preference import format_preferences, swapped_replies

PAGES = [(1, "http://www.a.org/x?y=1", "p" * 1500), (2, "https://b.org/", "p" * 1500), (3, "http://u@B.org:80/z", "p" * 999),
         (4, "http://b.org/z", "p" * 999), (5, None, None), (5, None, None), (None, "not a url", "p" * 1500), (7, "", ""),
         (8, "http://www.a.org/x?y=1", "é" * 600 + "\r\n\r\nWARC/1.1\r\n"), (9, "http://a b/\tc", "é" * 600 + "\r\n\r\nWARC/1.1\r\n")]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(3).selectExpr("*", "1 as digest", "2 as n")


def test_round_trip(pages):
    got = W.archive_round_trip(pages).collect()
    assert len(got) == len(PAGES)
    by = {r.page_id: r for r in got}
    for i, _, html in PAGES:
        data = (html or "").encode()
        assert (by[i].payload_bytes, by[i].payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
    assert {i: (r.record_type, r.refers_to) for i, r in by.items() if r.record_type == "revisit"} == {
        1: ("revisit", 2), None: ("revisit", 2), 8: ("revisit", 9)}
    assert W.archive_round_trip(pages.limit(0)).collect() == []


def test_files_and_lookup(spark, pages):
    folder, captures = W.write_archive(pages)
    index = W.write_index(captures, block_lines=2)
    keys = spark.createDataFrame([(r.sort_key,) for r in captures.collect()] + [("zz)/nowhere -",), ("",)], "sort_key string")
    found = W.lookup(keys, index).collect()
    assert sorted((r.file, r.offset) for r in found) == sorted((r.file, r.offset) for r in captures.collect())
    one = captures.where("page_id = 2").first()
    store, path = W._open(folder)
    with store.open_input_file(f"{path}/{one.file}") as f:
        member = gzip.decompress(f.read_at(one.length, one.offset))
    assert member.startswith(b"WARC/1.1\r\n") and member.endswith(b"p" * 1500 + b"\r\n\r\n")


def test_index_spans_blocks_and_files(spark):
    rows = spark.range(500).selectExpr("concat('k', lpad(cast(id div 7 as string), 3, '0'), ')/ 8') as sort_key", "id as page_id",
                                       "'response' as record_type", "'f' as file", "id as offset", "1L as length")
    index = W.write_index(rows.repartition(4), block_lines=3)
    got = W.lookup(rows.select("sort_key"), index).collect()
    assert sorted(r.offset for r in got) == list(range(500))


def test_surt(spark):
    urls = ["http://www.A.org/x?y", "https://u:p@b.org:8080", "plain", None, "http://h/a b"]
    df = spark.createDataFrame([(u,) for u in urls], "u string").select(W.surt(W.F.col("u")).alias("k"))
    assert [r.k for r in df.collect()] == ["org,a,www)/x?y", "org,b)", "plain", "", "h)/a%20b"]


def turns(spark, rows):
    return spark.createDataFrame(rows, "pair_id long, turn long, role string, text string")


def test_preferences(spark):
    chosen = [(1, 0, "user", "hi"), (1, 1, "assistant", "good"), (2, 0, "user", "q"), (3, 0, "user", "same"), (4, 0, "user", "x"),
              (None, 0, "user", "lost"), (5, None, None, None), (5, 2, "assistant", "é🙂")]
    rejected = [(1, 0, "user", "hi"), (1, 1, "assistant", "bad"), (1, 2, "user", "why"), (2, 0, "system", "q"), (3, 0, "user", "same"),
                (None, 0, "user", "lost"), (5, None, None, None), (5, 2, "assistant", "é")]
    got = {r.pair_id: r for r in format_preferences(turns(spark, chosen), turns(spark, rejected)).collect()}
    assert set(got) == {1, 2, 3, 5}
    one = got[1]
    assert (one.n_prompt_turns, one.prompt, one.chosen, one.rejected) == (
        1, "<|user|>\nhi\n", "<|assistant|>\ngood\n", "<|assistant|>\nbad\n<|user|>\nwhy\n")
    assert [one.chosen[m.start:m.end] for m in one.chosen_mask] == ["good"]
    assert [one.rejected[m.start:m.end] for m in one.rejected_mask] == ["bad"]
    assert (got[2].n_prompt_turns, got[2].prompt, list(got[2].chosen_mask)) == (0, "", [])
    assert (got[3].n_prompt_turns, got[3].chosen, got[3].rejected) == (1, "", "")
    assert got[5].n_prompt_turns == 1 or got[5].prompt == ""
    assert [got[5].chosen[m.start:m.end] for m in got[5].chosen_mask] == ["é🙂"]
    empty = turns(spark, [])
    assert format_preferences(empty, empty).collect() == []


def test_swapped_replies(spark):
    rows = [(0, 0, "user", "a"), (0, 1, "assistant", "b"), (1, 0, "user", "c"), (1, 1, "assistant", "d"), (2, 0, "user", "e"), (None, 0, "user", "z")]
    conversations = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as swap", "2 as at")
    chosen, rejected = swapped_replies(conversations)
    assert sorted((r.pair_id, r.turn, r.text) for r in rejected.collect()) == [(0, 0, "a"), (0, 1, "d"), (1, 0, "c"), (1, 1, "b")]
    assert chosen.count() == 4


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_queries_match_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("pages", "conversations", "documents"):
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    want = con.sql(Q.ORACLE[name])
    got = Q.QUERIES[name](spark, sf)
    names = sorted(want.columns)
    assert sorted(got.columns) == names
    order = [names.index(c) for c in names]
    rows = sorted((tuple(r[c] for c in names) for r in got.collect()), key=str)
    other = sorted((tuple(r[want.columns.index(names[k])] for k in order) for r in want.fetchall()), key=str)
    assert rows == other
