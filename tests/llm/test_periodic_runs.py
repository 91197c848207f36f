"""Periodic runs against the definition."""

import hashlib
import random
import zlib

import pytest

from txnrisk.llm.periodic_runs import periodic_runs, z_values
from txnrisk.llm.queries import op13_periodic_runs


def brute(words):
    """Every maximal stretch of every period, kept where it is the smallest."""
    n, stretches = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                stretches.setdefault((i, j + q), q)
            i = j
    runs = sorted((s, q, e - s) for (s, e), q in stretches.items())
    gone = {i for s, q, length in runs for i in range(s + q, s + length)}
    return runs, [w for i, w in enumerate(words) if i not in gone]


def cases():
    rng = random.Random(13)
    out = [None, "", " \n\t", "a a a a a", "a a a a a a", "a b " * 2 + "a b a", "a b " * 4, "x " * 3000,
           ("the same line again " * 40 + "\n") + "and more", "p q r " * 100 + "z " + "p q r " * 100, "\x85 é " * 9]
    for k in range(60):
        alphabet = "ab" if k % 2 else "abcd"
        words = [rng.choice(alphabet) for _ in range(rng.randrange(5, 90))]
        for _ in range(rng.randrange(3)):
            at, p = rng.randrange(len(words)), rng.randrange(1, 40)
            words[at:at] = (words[at:at + p] * rng.randrange(3, 9))[:rng.randrange(1, 300)]
        out.append(" ".join(words))
    return out


def check(got, texts):
    rows = {r["doc_id"]: r for r in got.collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        words = (text or "").encode().split()
        runs, kept = brute(words)
        r = rows[i]
        assert [tuple(x) for x in r["runs"]] == runs, text
        joined = b" ".join(kept).decode()
        assert r["n_words"] == len(words)
        assert r["collapsed"] == (joined if runs else None)
        assert r["collapsed_sha256"] == hashlib.sha256(joined.encode()).hexdigest()


def test_definition(docs_of):
    texts = cases()
    check(periodic_runs(docs_of([(i, t, "s") for i, t in enumerate(texts)])), texts)


def test_tiles_of_long_documents(docs_of):
    texts = cases()
    docs = docs_of([(i, t, "s") for i, t in enumerate(texts)]).withColumnRenamed("lang", "row")
    check(periodic_runs(docs, tile_words=16, long_words=20), texts)


def test_repeated_and_null_ids_and_empty_table(docs_of):
    rows = [(1, "a " * 8, "s"), (1, "a " * 8, "s"), (1, "b", "s"), (None, "c d " * 5, "s"), (None, None, "s")]
    got = sorted((repr(r["doc_id"]), len(r["runs"]), r["collapsed"]) for r in periodic_runs(docs_of(rows)).collect())
    assert got == sorted([("1", 1, "a"), ("1", 1, "a"), ("1", 0, None), ("None", 1, "c d"), ("None", 0, None)], key=repr)
    assert periodic_runs(docs_of([])).collect() == []


@pytest.mark.parametrize("text", ["", "a", "aaaa", "abababc", "abcabcabx"])
def test_z(text):
    s = [ord(c) for c in text]
    assert z_values(s) == [next((k for k in range(len(s) - i) if s[k] != s[i + k]), len(s) - i) for i in range(len(s))]


def test_query(spark, small):
    _, rows = small
    got = {r["doc_id"]: r for r in op13_periodic_runs(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(rows)
    n_edited = 0
    for i, text in rows:
        words = (text or "").encode().split()
        n, h = len(words), zlib.crc32(str(i).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (k - a) % p] for k in range(a, n)]
            n_edited += 1
        runs, kept = brute(words) if n < 3000 else (None, None)
        r = got[i]
        if runs is None:
            continue
        best = max(runs, key=lambda x: (x[2], -x[0], -x[1]), default=None)
        assert r["n_runs"] == len(runs)
        assert (r["start"], r["period"], r["length"]) == (best or (None, None, None))
        assert r["exponent_milli"] == (1000 * best[2] // best[1] if best else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, q, m in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(b" ".join(kept)).hexdigest()
    assert n_edited
