"""Line dedup, n-gram join, repeated byte strings and SpotSigs against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from txnrisk.llm.bwt import by_symbol, merge, shard_bwt
from txnrisk.llm.common import perhaps_in
from txnrisk.llm import components, line_dedup
from txnrisk.llm.components import PairsInBuckets, connected_components, linked_groups, pairs_between_groups
from txnrisk.llm.line_dedup import BITS, MAX_DISTANCE, dedup_lines, line_meetings, line_signatures
from txnrisk.llm.ngram_join import jaccard_groups, keep_first
from txnrisk.llm.spotsigs import ANCHORS, compare_edited, similar_groups
from txnrisk.llm.suffix_dedup import drop_repeats

WORDS = [a + b + c for a in ("ka", "lo", "mi", "ru", "se") for b in ("ton", "ver", "lin", "dak") for c in ("a", "os", "el", "u")]


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


def edited(text, seed, changes):
    r, words = random.Random(seed), text.split()
    for _ in range(changes):
        words[r.randrange(len(words))] = r.choice(WORDS) + "x"
    return " ".join(words)


class Groups:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


ODD = [(None, None, "a"), (1, "", "a"), (2, "  \t ", None), (3, "one", "a"), (4, "ONE", "a"), (5, "one two", "b"),
       (5, "one two", "b"), (6, "nul\x00byte " * 40, "b"), (7, "é" * 300, "c"), (8, "é" * 300 + " tail", "c")]


def corpus(seed=1, n=60):
    rows = [(k, prose(seed * 1000 + k, 30 + k % 90), "s") for k in range(n)]
    for k in range(n, 2 * n):
        base = rows[k % 12][1]  # groups of near copies
        rows.append((k, edited(base, k, k % 9), "s"))
    return rows + [(500 + k, rows[3][1], "s") for k in range(20)]


def test_connected_components(spark):
    r = random.Random(5)
    edges = [(k, k + 1) for k in range(60)] + [(100 + r.randrange(40), 100 + r.randrange(40)) for _ in range(30)] + [(7, 7)]
    g = Groups({x for e in edges for x in e})
    for a, b in edges:
        g.join(a, b)
    got = {x.id: x.component for x in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: g.find(x) for x in got} and {x for a, b in edges if a != b for x in (a, b)} == set(got)
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[k:k + n]) for k in range(len(words) - n + 1)}


@pytest.mark.parametrize("n,percent", [(4, 85), (5, 80), (2, 40)])
def test_ngram_join(docs_of, n, percent):
    rows = corpus()
    sets = {i: shingles(t, n) for i, t, _ in rows}
    g = Groups(sets)
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                g.join(a, b)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_groups(docs_of(rows), n, percent).collect()}
    assert got == {i: (len(sets[i]), g.find(i)) for i in sets}
    kept = {r.doc_id for r in keep_first(docs_of(rows), n, percent).collect()}
    assert kept == {g.find(i) for i in sets}


def test_ngram_join_odd_rows(docs_of):
    docs = docs_of(ODD).selectExpr("*", "1 as n", "2 as id", "3 as component_id", "4 as _gone")
    got = sorted(((r.doc_id is None, r.doc_id), r.n_shingles, r.component_id, r.links) for r in jaccard_groups(docs).collect())
    by = {k[0][1]: k[1:] for k in got}
    assert len(got) == len(ODD) and by[4] == (1, 3, True) and by[1][0] == by[2][0] == by[None][0] == 0
    kept = keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["None", "1", "2", "3", "5", "6", "7", "8"])
    assert jaccard_groups(docs.limit(0)).collect() == []


def lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_line_dedup_against_all_pairs(docs_of):
    lines = [prose(k, 4 + k % 90) for k in range(80)]
    lines += [edited(lines[k % 80], k, 1) for k in range(120)] + ["A b.", "a  B", "-", "-", ""]
    r = random.Random(3)
    r.shuffle(lines)
    rows = [(k, "\n".join(lines[k * 5:k * 5 + 5]), "s") for k in range(41)]
    docs = docs_of(rows)
    signature = {(x.doc_id, x.line_no): x.simhash for x in line_signatures(docs).where("n_words > 0").collect()}
    norm = {(i, k): " ".join(w for w in re.split(r"[\s!-/:-@\[-`{-~]+", x.lower()) if w)
            for i, t, _ in rows for k, x in enumerate(t.split("\n"))}
    norm = {k: v for k, v in norm.items() if v}
    assert set(signature) == set(norm)
    g, keys, links = Groups(norm), sorted(norm), 0
    for a in keys:
        for b in keys:
            if a < b and bin(signature[a] ^ signature[b]).count("1") <= MAX_DISTANCE:
                x, y = norm[a], norm[b]
                n = max(len(x), len(y))
                if min(len(x), len(y)) >= 0.8 * n and lev(x, y) <= 0.2 * n:
                    g.join(a, b)
                    links += x != y
    assert links > 10
    got = {r.doc_id: (r.text, list(r.removed_line_numbers)) for r in dedup_lines(docs).collect()}
    for i, t, _ in rows:
        gone = [k for k in range(len(t.split("\n"))) if (i, k) in norm and g.find((i, k)) != (i, k)]
        assert got[i] == ("\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone), gone)


def test_line_dedup_finds_small_changes_whatever_the_length(docs_of):
    """Copies with a changed character, a changed word and a word less, far
    apart in SimHash bits or not; lines too short for a change are left out."""
    rows = []
    for n in (2, 5, 7, 8, 9, 13, 19, 40, 75):
        for k in range(3):
            r, words = random.Random(100 * n + k), prose(100 * n + k, n).split()
            at = r.randrange(n)
            less = words[:at] + words[at + 1:]
            word = [*words[:at], r.choice(WORDS)[::-1], *words[at + 1:]]
            text = " ".join(words)
            c = r.randrange(len(text) // 2)
            char = text[:c] + ("y" if text[c] != " " else " ") + text[c + 1:]
            rows += [(len(rows), "\n".join([text, char] + [" ".join(w) for w in (word, less) if n > 5]), "s")]
    got = dedup_lines(docs_of(rows)).collect()
    assert {r.doc_id: list(r.removed_line_numbers) for r in got} == {
        i: list(range(1, 1 + t.count("\n"))) for i, t, _ in rows}


def test_simhash_of_long_lines(docs_of):
    """Lines of more words than one sum holds."""
    texts = [" ".join(f"{seed}w{k}" for k in range(n)) for seed, n in ((1, 8), (1, 254), (2, 255), (3, 256), (4, 1500))]
    docs = docs_of([(k, t, "s") for k, t in enumerate(texts)])
    words = docs.select("doc_id", F.explode(F.split("text", " ")).alias("w")).select("doc_id", F.xxhash64("w").alias("h"))
    hashes = {}
    for r in words.collect():
        hashes.setdefault(r.doc_id, []).append(r.h)
    want = {k: sum(1 << b for b in range(BITS) if 2 * sum(x >> b & 1 for x in h) > len(h)) for k, h in hashes.items()}
    assert {r.doc_id: r.simhash for r in line_signatures(docs).collect()} == want


def test_simhash_of_short_lines_takes_character_grams(docs_of):
    docs = docs_of([(1, "abc d", "s"), (2, "x", "s"), (3, "", "s")])
    grams = docs.select(F.xxhash64(F.lit("abc")), F.xxhash64(F.lit("bc ")), F.xxhash64(F.lit("c d")), F.xxhash64(F.lit("x"))).first()
    want = sum(1 << b for b in range(BITS) if 2 * sum(h >> b & 1 for h in grams[:3]) > 3)
    got = {r.doc_id: r.simhash for r in line_signatures(docs).where("n_words > 0").collect()}
    assert got == {1: want, 2: grams[3] & (1 << BITS) - 1}


def test_items_that_share_buckets_are_paired_once(spark):
    """40 items in five common buckets and one of their own parity each: every
    pair of different groups once, not once a bucket; and the same groups."""
    rows = [(key, (i, 0)) for i in range(40) for key in (-5, -4, 7, 8, 9, 100 + i % 2)]
    postings = spark.createDataFrame(rows, "key long, item struct<id long, order long>")
    rest = postings.withColumn("own", F.col("item.id") % 10).withColumn(
        "keys", F.collect_list("key").over(Window.partitionBy("item.id")))
    got = sorted((r.a, r.b) for r in pairs_between_groups(rest, lambda x, y: F.lit(True), True).collect())
    assert got == [(a, b) for a in range(40) for b in range(a + 1, 40) if a % 10 != b % 10]

    def groups(few_keys):
        found = linked_groups(postings, lambda x, y: F.lit(True), lambda p: p.where("(b - a) % 10 = 0"), "order", few_keys=few_keys)
        return sorted((r.id, r.component) for r in found.collect())
    assert groups(True) == groups(False) == [(i, i % 10) for i in range(40)]


@pytest.mark.parametrize("chunk", [4, 512])
def test_pairs_are_compared_in_their_buckets(spark, monkeypatch, chunk):
    """Parts and bands of a bucket lose no pair, make none twice, and only linked
    ones leave it."""
    monkeypatch.setattr(components, "CHUNK", chunk)
    r = random.Random(9)
    items = {i: (i % 6, r.randrange(40, 90)) for i in range(60)}
    keys = {i: [k for k in range(3) if (i + k) % 4] for i in items}
    rest = spark.createDataFrame([(k, (i, n), own, keys[i]) for i, (own, n) in items.items() for k in keys[i]],
                                 "key long, item struct<id long, n long>, own long, keys array<long>")
    texts = spark.createDataFrame([(i, "x" * (i % 5)) for i in items], "id long, form string")
    within = PairsInBuckets(texts, lambda x, y: x["form"] == y["form"], lambda x: F.floor(x["n"] / 10))
    got = sorted((p.a, p.b) for p in pairs_between_groups(
        components._with_texts(rest, texts), lambda x, y: F.abs(x["n"] - y["n"]) <= 10, True, within).collect())
    assert got == [(a, b) for a in items for b in items if a < b and a % 5 == b % 5 and items[a][0] != items[b][0]
                   and abs(items[a][1] - items[b][1]) <= 10 and set(keys[a]) & set(keys[b])]
    assert len(got) > 20


def test_lines_that_meet_by_chance_are_left(spark):
    """Lines that agree in two blocks of bits but differ in most others, in buckets
    of two, three and four, ask for no texts; those near to another one do."""
    far = ((1 << 37) - 1) << 26  # all but the first two blocks
    rows = [(1, 5, 100), (2, 5 ^ far, 100),  # two
            (11, 1 << 13, 100), (12, 1 << 13 ^ far, 100), (13, (1 << 13) ^ (far & far << 20), 100),  # three
            (21, 9, 100), (22, 9 ^ 7 << 30, 100), (23, 9 ^ far, 100), (24, 9 ^ 7 << 50, 130),  # one near, one too long
            (31, 77 << 13, 1 << 25), (32, 77 << 13 ^ 1 << 40, 1 << 26)]  # too long for the facts
    distinct = spark.createDataFrame([(i, h, n, []) for i, h, n in rows], "id long, simhash long, n_chars int, blocks array<long>")
    met = [(r.key, r.id) for r in line_meetings(distinct).collect() if r.key >> 32 == 0]
    assert sorted(i for _, i in met) == [21, 22, 31, 32]
    of_words = distinct.where("id < 30").withColumn("blocks", F.array(F.lit(3).cast("long"), F.col("id") + 100))
    assert sorted(r.id for r in line_meetings(of_words).collect() if r.key < 0) == [1, 2, 11, 12, 13, 21, 22, 23]


def test_least_edits_counts_letters(spark):
    """No more than the edit distance, and what letters alone tell."""
    lines = [prose(k, 3 + k % 40) for k in range(30)] + [edited(prose(k, 20), k, 3) for k in range(10)] + ["e" * 400, "e" * 90 + "t" * 30]
    df = spark.createDataFrame(list(enumerate(lines)), "id long, form string").select("id", "form", *line_dedup._letters(F.col("form")))
    pairs = df.select(F.struct("*").alias("x")).crossJoin(df.select(F.struct("*").alias("y")))
    got = pairs.select("x.form", F.col("y.form").alias("other"), line_dedup._least_edits(F.col("x"), F.col("y")).alias("n")).collect()

    def counts(line):
        return [min(255, sum(c in lane for c in line)) for lane in line_dedup.LANES]
    for form, other, n in got:
        d = [a - b for a, b in zip(counts(form), counts(other), strict=True)]
        assert n == max(sum(x for x in d if x > 0), -sum(x for x in d if x < 0))
    assert all(n <= lev(form, other) for form, other, n in got if len(form) + len(other) < 200)


def test_bitmap_grows_with_its_keys(spark):
    """Few strangers pass where there are many keys; every key does."""
    keys, others = spark.range(60_000), spark.range(1_000_000, 1_060_000)
    there = perhaps_in(keys, F.xxhash64("id"), F.xxhash64("id"), 1 << 19)
    assert keys.where(there).count() == 60_000
    assert others.where(there).count() < 9_000


def test_line_dedup_odd_rows(docs_of):
    docs = docs_of(ODD).selectExpr("*", "1 as gone", "2 as id", "'x' as removed_line_numbers", "3 as row")
    got = dedup_lines(docs)
    assert got.columns == [c for c in docs.columns if c != "removed_line_numbers"] + ["removed_line_numbers"]
    by = {}
    for r in got.collect():
        by.setdefault(r.doc_id, []).append(r.text)
    assert by[None] == [None] and by[2] == ["  \t "] and by[3] == ["one"] and by[4] == [""] and by[5] == ["one two"] * 2
    assert dedup_lines(docs.limit(0)).collect() == []


def brute_repeats(rows, length=100):
    seen, out = set(), []
    for i, text in rows:
        b = (text or "").encode()
        gone = np.zeros(len(b), dtype=bool)
        for s in range(len(b) - length + 1):
            if b[s:s + length] in seen:
                gone[s:s + length] = True
            seen.add(b[s:s + length])
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def digests(df):
    return sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in df.collect())


def test_repeats_against_brute_force(docs_of, small):
    rows = corpus(7) + [(900, "ab" * 400, "s"), (901, "\n".join(["x" * 130] * 4), "s"), (902, prose(7003, 33), "s")]
    assert digests(drop_repeats(docs_of(rows, 5))) == sorted(brute_repeats(sorted((i, t) for i, t, _ in rows)))
    df, texts = small
    assert digests(drop_repeats(df)) == brute_repeats(texts)


def test_repeats_odd_rows(docs_of):
    docs = docs_of(ODD).selectExpr("*", "1 as chunk", "2 as ids", "3 as kept")
    got = drop_repeats(docs).collect()
    assert len(got) == len(ODD)
    by = {r.doc_id: r for r in got}
    assert by[None].n_bytes == by[1].n_removed == 0
    assert by[8].n_removed >= 598 and by[7].n_removed == 600 - 100 - 2 * 0 or by[7].n_removed > 0
    assert drop_repeats(docs.limit(0)).collect() == []


def test_merge_orders_suffixes():
    """The merged interleave of shards is the order of all suffixes, and its
    borders are the common prefixes."""
    rng = np.random.default_rng(2)
    block, depth = 2, 3
    texts = [rng.integers(0, 2, rng.integers(8, 30)).astype(np.uint8) for _ in range(12)]
    buf = np.concatenate(texts)
    end = np.cumsum([len(t) for t in texts])
    start = end - [len(t) for t in texts]
    symbol = (buf[:-1] * 2 + buf[1:] + 1).astype(np.uint32)
    shards = [shard_bwt(symbol, start[k::3], end[k::3] - block + 1, block, depth) for k in range(3)]
    position, common = merge(shards)
    string_end = {p: e for s, e in zip(start, end, strict=True) for p in range(s, e - block + 1)}
    live = [int(p) for p in position if p >= 0]
    assert sorted(live) == sorted(string_end)
    prefix = {p: [int(symbol[q]) for q in range(p, min(string_end[p] - block + 1, p + depth * block), block)] for p in live}
    assert [prefix[p] for p in live] == sorted(prefix.values())
    for k in range(1, len(position)):
        if position[k] >= 0 and position[k - 1] >= 0:
            a, b = prefix[int(position[k - 1])], prefix[int(position[k])]
            same = next((j for j in range(depth) if a[j:j + 1] != b[j:j + 1]), depth)
            # equal short strings end together: their ends count as common
            assert common[k] == same or a == b and len(a) < depth
    assert by_symbol(np.array([70000, 1, 70000, 0], dtype=np.uint32)).tolist() == [3, 1, 0, 2]


def brute_signatures(text):
    words = [w for w in re.split(r"[\s!-/:-@\[-`{-~]+", text.lower()) if w]
    out = set()
    for k, w in enumerate(words):
        if w in ANCHORS:
            out.add((w, *[x for x in words[k:] if x not in ANCHORS][:2]))
    return out or {("", *words)}


def anchored(text):
    return " ".join(f"the {w}" if k % 3 == 0 else w for k, w in enumerate(text.split()))


def test_spotsigs_compare(docs_of, small):
    df, texts = small
    order = sorted(texts, reverse=True)
    got = {r.doc_id: r for r in compare_edited(df).collect()}
    assert len(got) == len(order)
    for (i, t), (_, after) in zip(order, [*order[1:], order[0]], strict=True):
        t, after = t or "", after or ""
        new = t[:len(t) - len(t) // 3] + after[:len(t) // 3]
        own, changed, following = map(brute_signatures, (t, new, after))
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(new.encode()).hexdigest())
        assert len(r.fingerprint) == 8 * len(own) and len(r.edited_fingerprint) == 8 * len(changed)
        assert abs(r.near_edited - len(own & changed) / len(own | changed)) < 1e-9
        assert abs(r.near_next - len(own & following) / len(own | following)) < 1e-9


def test_spotsigs_odd_rows(docs_of):
    docs = docs_of(ODD).selectExpr("*", "1 as own", "2 as after", "3 as block", "4 as hash")
    got = compare_edited(docs).collect()
    assert len(got) == len(ODD) and all(0 <= r.near_edited <= 1 for r in got)
    assert len({r.fingerprint for r in got if r.doc_id in (1, None)}) == 1
    alone = compare_edited(docs.where("doc_id = 7")).collect()
    assert len(alone) == 1 and alone[0].near_next == 1
    assert compare_edited(docs.limit(0)).collect() == []


def test_spotsigs_groups(docs_of):
    rows = [(i, anchored(t), s) for i, t, s in corpus(4)]
    sets = {i: brute_signatures(t) for i, t, _ in rows}
    g = Groups(sets)
    for a in sets:
        for b in sets:
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                g.join(a, b)
    got = {r.doc_id: r.group_id for r in similar_groups(docs_of(rows)).collect()}
    assert got == {i: g.find(i) for i in sets} and len(set(got.values())) < len(got)
