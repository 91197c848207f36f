from collections import defaultdict

from txnrisk.llm.mixing import apply_mix, mix_sources, round_copies

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()


def text(k, n):
    return " ".join(WORDS[(k * 7 + j) % 10] for j in range(n))


def brute_targets(size_of, weights=(3, 1, 2), share=1.5, cap=2.0):
    names = sorted(size_of, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target = {s: share * sum(size_of.values()) * weight[s] / sum(weight.values()) for s in names}
    while True:
        over = {s for s in names if target[s] > cap * size_of[s] + 1e-9}
        if not over:
            return target
        excess = sum(target[s] - cap * size_of[s] for s in over)
        for s in over:
            target[s] = cap * size_of[s]
        free = [s for s in names if target[s] < cap * size_of[s] - 1e-9]
        for s in free:
            target[s] += excess * weight[s] / sum(weight[x] for x in free)


def test_targets_and_rounding(docs_of):
    rows = [(k, text(k, 5 + k * 37 % 60), ["a", "b", "c", None, "é"][k % 5] if k % 3 else "a") for k in range(400)]
    got = mix_sources(docs_of(rows)).collect()
    assert len(got) == len(rows)
    size_of, taken, most = defaultdict(int), defaultdict(int), defaultdict(int)
    source = {i: s for i, _, s in rows}
    for r in got:
        s = source[r.doc_id]
        size_of[s] += r["size"]
        taken[s] += r.copies * r["size"]
        most[s] = max(most[s], r["size"])
        assert r.copies in (0, 1, 2)
    target = brute_targets(size_of)
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == size_of[s] and abs(r.target - target[s]) < 1e-6
    for s in size_of:
        assert abs(taken[s] - target[s]) <= most[s] / 2 + 1e-6


def test_reruns_agree_on_any_partitioning(docs_of):
    rows = [(k, text(k, 5 + k % 50), f"s{k % 3}") for k in range(300)]
    one, two = (sorted(map(tuple, mix_sources(docs_of(rows, p)).collect())) for p in (1, 7))
    assert one == two


def test_expectation_is_kept(spark):
    """Over many seeds, each document is taken with its probability."""
    rows = spark.createDataFrame([(k, 1, 10 + k, 0.3 + 0.05 * (k % 5)) for k in range(9)], "doc_id long, source_no long, size long, p double")
    total = defaultdict(float)
    for seed in range(25):
        for r in round_copies(rows, seed * 100, fan=4).collect():
            total[r.doc_id] += r.p / 25
    mean = sum(total.values()) / 9
    assert 0.25 < mean < 0.55 and min(total.values()) > 0 and max(total.values()) < 1


def test_odd_rows(docs_of):
    rows = [(1, None, None), (1, "", "a"), (2, "a b c", "a"), (2, "a b c", "a"), (None, "x y", None), (3, "  ", "b")]
    docs = docs_of(rows).selectExpr("*", "0 as size", "0 as copies", "0 as nth", "0 as row", "0 as doc")
    got = mix_sources(docs)
    assert got.count() == len(rows) and got.where("size = 0 and copies > 0").count() == 0
    mixed = apply_mix(docs, got)
    assert mixed.columns == docs.columns
    assert mixed.count() == got.selectExpr("sum(copies)").first()[0]
    assert mix_sources(docs.limit(0)).collect() == []
