from txnrisk import constants as K
from txnrisk.operators import rules as R
from txnrisk.operators import trace as TR
from pyspark.sql import functions as F


def _points_df(spark, rows):
    cols = [R.indicator_column_name(t, i) for _, t, i in R.indicator_ids()]
    data = []
    for cid, vals in rows:
        data.append(tuple([cid] + [float(vals.get(c, 0.0)) for c in cols]))
    return spark.createDataFrame(data, ["customer_id"] + cols)


def _trace(spark, rows):
    df = TR.with_indicator_trace(_points_df(spark, rows))
    return {r["customer_id"]: r["rule_indicator_trace"] for r in df.collect()}


def test_empty_and_threshold(spark):
    t = _trace(spark, [(1, {}), (2, {"Struct::STRUCT-001": 0.05}), (3, {"Geo::GEO-001": 0.10})])
    assert t[1] == ""
    # 0.05 x 0.30 = 0.015 (IEEE) is kept; 0.10 x 0.13 = 0.013 is dropped
    assert t[2] == "Struct: STRUCT-001(L)"
    assert t[3] == ""


def test_severity_and_grouping(spark):
    rows = [(1, {"Geo::GEO-002": 0.55, "Struct::STRUCT-001": 0.20, "Struct::PROF-007": 0.21,
                 "HT::HT-SEX-12": 0.45, "Trade::GATE-001": 0.35, "Behav::ACCT-004": 0.12})]
    t = _trace(spark, rows)[1]
    # impacts: GATE .0875, PROF-007 .063, STRUCT-001 .06, GEO-002 .0715, HT-SEX-12 .054, ACCT-004 .024
    assert t == "Trade: GATE-001(H) | Geo: GEO-002(H) | Struct: PROF-007(H), STRUCT-001(M) | HT: HT-SEX-12(H)"


def test_ties_keep_column_order(spark):
    rows = [(1, {"Struct::STRUCT-006": 0.10, "Struct::STRUCT-001": 0.10})]
    assert _trace(spark, rows)[1] == "Struct: STRUCT-001(M), STRUCT-006(M)"


def test_at_most_five_items(spark):
    vals = {R.indicator_column_name(t, i): 0.3 for _, t, i in R.indicator_ids()}
    t = _trace(spark, [(1, vals)])[1]
    assert sum(len(seg.split(":")[1].split(",")) for seg in t.split("|")) == 5


def test_trace_counts(spark):
    df = spark.createDataFrame([
        (1, "Struct: A(H), B(M) | Geo: C(L)"),
        (2, ""),
        (3, "structuring_layering: X(H) | cross-border: Y(L), | nocolon"),
        (4, None),
    ], "customer_id long, t string")
    c = TR.trace_counts(F.col("t"))
    out = {r["customer_id"]: r for r in df.select("customer_id", *[c[x].alias(x) for x in K.TYPOLOGIES]).collect()}
    assert out[1]["structuring_layering"] == 2 and out[1]["cross_border_geo"] == 1
    assert all(out[2][x] == 0 for x in K.TYPOLOGIES)
    assert out[3]["structuring_layering"] == 1 and out[3]["cross_border_geo"] == 1
    assert all(out[4][x] == 0 for x in K.TYPOLOGIES)
