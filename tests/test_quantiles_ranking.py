import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from txnrisk.functions.columns import from_sort_key, sort_key
from txnrisk.operators.quantiles import QSpec, exact_quantiles, grouped_median
from txnrisk.operators.ranking import ordinal_rank, running_total


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    vals = np.concatenate([rng.normal(size=900), np.full(100, 0.5)])
    pdf = pd.DataFrame({"a": vals, "b": np.where(np.arange(1000) % 3 == 0, np.nan, vals * 2)})
    df = spark.createDataFrame(pdf)
    specs = [QSpec(f"{c}|{p}", f"`{c}`", p) for c in "ab" for p in (0.0, 0.25, 0.5, 0.9, 0.99, 1.0)]
    got = exact_quantiles(df, specs)
    for s in specs:
        col = pdf[s.name.split("|")[0]].dropna().to_numpy()
        assert abs(got[s.name] - np.percentile(col, s.p * 100)) < 1e-9, s.name


def test_sort_key_is_the_order_of_doubles(spark):
    rng = np.random.default_rng(8)
    any_bits = rng.integers(-2 ** 63, 2 ** 63, 3000, dtype=np.int64).view(np.float64)
    powers = np.array([2.0 ** e for e in range(-1074, 1024)])
    near = np.concatenate([np.nextafter(powers, 0), powers, np.nextafter(powers, np.inf)])
    values = np.concatenate([any_bits[~np.isnan(any_bits)], near, -near, [0.0, -0.0, np.inf, -np.inf, 5e-324]])
    df = spark.createDataFrame(pd.DataFrame({"v": values}))
    rows = df.select("v", sort_key(F.col("v")).alias("k")).collect()
    assert all(from_sort_key(r.k) == r.v for r in rows)
    rows.sort(key=lambda r: r.k)
    assert all(a.v < b.v or a.v == b.v and a.k == b.k for a, b in zip(rows, rows[1:]))


def test_quantiles_of_odd_columns(spark):
    pdf = pd.DataFrame({"same": [2.5] * 5, "wide": [-1e300, -1e-300, 0.0, 1e-300, 1e300],
                        "near": [1.0, np.nextafter(1.0, 2), np.nextafter(1.0, 0), 1.0, 1.0], "none": [np.nan] * 5})
    specs = [QSpec(f"{c}|{p}", f"`{c}`", p) for c in pdf for p in (0.0, 0.1, 0.5, 0.75, 1.0)]
    got = exact_quantiles(spark.createDataFrame(pdf), specs)
    for s in specs:
        c = s.name.split("|")[0]
        assert got[s.name] is None if c == "none" else got[s.name] == np.percentile(pdf[c], s.p * 100)
    assert exact_quantiles(spark.createDataFrame(pdf).limit(0), specs[:1]) == {"same|0.0": None}


def test_grouped_median_with_hot_key(spark):
    rng = np.random.default_rng(5)
    keys = np.concatenate([np.zeros(3000, dtype=int), rng.integers(1, 50, 2000)])
    vals = rng.integers(0, 400, len(keys)).astype(float)
    pdf = pd.DataFrame({"k": keys, "v": vals})
    got = {r["k"]: r["m"] for r in grouped_median(spark.createDataFrame(pdf), "k", "v", "m").collect()}
    exp = pdf.groupby("k")["v"].median()
    for k, m in exp.items():
        assert abs(got[k] - m) < 1e-9


def test_ordinal_rank_and_running_total(spark):
    pdf = pd.DataFrame({"id": range(500), "g": [i % 3 for i in range(500)], "s": [(i * 37) % 101 for i in range(500)]})
    df = spark.createDataFrame(pdf)
    r = ordinal_rank(df, [F.col("s").desc(), F.col("id").asc()], ["g"]).toPandas()
    exp = pdf.sort_values(["g", "s", "id"], ascending=[True, False, True])
    exp["rank"] = exp.groupby("g").cumcount() + 1
    m = r.merge(exp, on=["id", "g", "s"], suffixes=("", "_exp"))
    assert (m["rank"] == m["rank_exp"]).all() and len(m) == 500
    rt = running_total(df, [F.col("id").asc()], None, F.col("s"), "cum").toPandas().sort_values("id")
    assert (rt["cum"].to_numpy() == pdf["s"].cumsum().to_numpy()).all()


def test_quantiles_pass_over_their_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(len(b))
            yield b.assign(v=1 + b["id"] * 1e-9)  # keys that differ in their last digits only

    df = spark.range(500).mapInPandas(counted, "id long, v double")
    q = exact_quantiles(df, [QSpec("m", "v", 0.5), QSpec("p", "v", 0.99)])
    assert abs(q["m"] - (1 + 249.5e-9)) < 1e-15
    assert seen.value == 500


def test_medians_of_ordinary_groups_need_no_range_table(spark, monkeypatch):
    """Only the values of a hot key go through the range-partitioned total."""
    from txnrisk.operators import quantiles, ranking

    rows = [(k, float((i * 7919 + k) % 101)) for k, n in ((1, 400), (2, 7), (3, 2), (4, 1)) for i in range(n)]
    rows += [(5, None), (2, float("nan")), (None, 3.0), (None, 4.0)]
    df = spark.createDataFrame(rows, "k long, v double")
    want = {k: float(np.median([v for key, v in rows if key == k and v is not None and v == v])) for k in (1, 2, 3, 4, None)}
    totals, keys = ranking.running_total, []

    def spread(df_, *args, **kwargs):
        keys.append({r.k for r in df_.select("k").distinct().collect()})
        return totals(df_, *args, **kwargs)

    monkeypatch.setattr(ranking, "running_total", spread)
    assert {r.k: r.m for r in grouped_median(df, "k", "v", "m").collect()} == want
    assert keys == []
    monkeypatch.setattr(quantiles, "HOT_ROWS", 50)
    assert {r.k: r.m for r in grouped_median(df, "k", "v", "m").collect()} == want
    assert keys == [{1}]


def test_medians_of_ordinary_groups_sort_no_rows(spark):
    df = spark.createDataFrame([(i % 3, float(i)) for i in range(30)], "k long, v double")
    median = grouped_median(df, "k", "v", "m")
    assert "Window" not in median._jdf.queryExecution().toString()
    assert {r.k: r.m for r in median.collect()} == {0: 13.5, 1: 14.5, 2: 15.5}
