"""Feistel shards: laws, round trip, reruns, odd tables."""

import zlib

import pytest
from pyspark.sql import functions as F

from txnrisk.llm.queries import op12_feistel_shards
from txnrisk.llm.sharding import network, permuted, round_keys, row_at, shuffle_shards, sides


def brute_place(x, n, seed):
    a, b = sides(n)
    p = (1 << 31) - 1
    while True:
        left, right = divmod(x, b)
        for r, (k, m, q) in enumerate(round_keys(seed)):
            t = ((right if r % 2 == 0 else left) * k + m) % p
            t = (t * t % p * q + t) % p
            if r % 2 == 0:
                left = (left + t) % a
            else:
                right = (right + t) % b
        x = left * b + right
        if x < n:
            return x


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 1000])
def test_permutation_and_inverse(spark, n):
    rows = permuted(spark.range(n), "id", n, 7, "place")
    got = {r["id"]: r["place"] for r in rows.collect()}
    assert sorted(got.values()) == list(range(n))
    assert got == {x: brute_place(x, n, 7) for x in range(n)}
    back = permuted(rows, "place", n, 7, "again", back=True)
    assert back.where("again <> id").count() == 0


def test_numbers_beyond_doubles(spark):
    n = (1 << 60) + 12345
    x = spark.range(n - 5, n).withColumn("to", network(F.col("id"), n, 3))
    for r in x.collect():
        a, b = sides(n)
        assert 0 <= r["to"] < a * b
    assert x.withColumn("b", network(F.col("to"), n, 3, back=True)).where("b <> id").count() == 0


def test_laws_on_the_whole_table(spark, small):
    _, rows = small
    got = op12_feistel_shards(spark, "/root/testdata/sf0.001").collect()
    text = dict(rows)
    assert sorted(r["doc_id"] for r in got) == sorted(text)
    by = {}
    for r in got:
        data = (text[r["doc_id"]] or "").encode()
        assert r["size"] == len(data) + 16 and r["text_crc32"] == zlib.crc32(data)
        assert r["law"] == "rows" and r["grown_shard"] is None
        by.setdefault(r["shard"], []).append(r["slot"])
    assert set(by) <= set(range(40))
    counts = [len(by.get(s, [])) for s in range(40)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    # the place follows from the row number
    for k, r in enumerate(sorted(got, key=lambda r: r["doc_id"])):
        p = brute_place(k, len(got), 0)
        assert (r["shard"], r["slot"]) == (p % 40, p // 40)


def test_round_trip_reruns_and_partitions(spark, docs_of):
    rows = [(i % 50, f"t{i % 7}", "s") for i in range(200)] + [(None, None, "s")] * 3
    one = shuffle_shards(docs_of(rows, 1), 6, seed=5)
    two = shuffle_shards(docs_of(rows, 5), 6, seed=5)
    key = lambda df: sorted((repr(tuple(r)) for r in df.collect()))
    assert key(one) == key(two)
    assert key(one) != key(shuffle_shards(docs_of(rows, 1), 6, seed=6))
    back = row_at(one.withColumnRenamed("row_number", "was"), 203, 6, seed=5)
    assert back.count() == 203 and back.where("was <> row_number").count() == 0


def test_empty_and_clashing_columns(spark, docs_of):
    assert shuffle_shards(docs_of([]), 4).collect() == []
    odd = spark.createDataFrame([(1, 9, 8, {"a": 1}, "x"), (2, 9, 8, {"a": 2}, None)],
                                "doc_id long, shard int, _id int, row map<string,int>, `a.b` string")
    got = shuffle_shards(odd, 2)
    assert got.columns == ["doc_id", "_id", "row", "a.b", "row_number", "shard", "slot"]
    assert sorted(r["row_number"] for r in got.collect()) == [0, 1]
    assert [r["row_number"] for r in shuffle_shards(odd, 2, id_col="a.b").orderBy("doc_id").collect()] == [1, 0]
