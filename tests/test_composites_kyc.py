"""Population statistics, KYC and fusion traps."""

import datetime as dt

from pyspark.sql import functions as F

from txnrisk import constants as K
from txnrisk.functions.columns import argmax_label
from txnrisk.operators import composites as C
from txnrisk.operators import fusion as FU
from txnrisk.operators.anomaly import log_columns
from txnrisk.operators.kyc import attach_kyc_risk_tiers, kyc_features


def test_p99_fallback_to_one(spark):
    df = spark.createDataFrame([(i, 0.0, float(i)) for i in range(10)], "customer_id long, z double, v double")
    p = C.population_p99(df, ["z", "v"])
    assert p["z"] == 1.0                          # p99 <= 0 -> 1.0 (T11)
    assert abs(p["v"] - 8.91) < 1e-9              # linear interpolation (T10)


def test_empty_segment_uses_one(spark):
    rows = [(i, 1, 0, float(i), float(i), float(i), float(i), float(i)) for i in range(5)]
    df = spark.createDataFrame(rows, "customer_id long, is_individual int, is_business int, total_outflow double, "
                                     "total_inflow double, total_volume double, transactions_per_active_day double, "
                                     "flow_through_ratio double")
    st = C.segment_stats(df)
    assert st["total_volume|bus|median"] == 1.0 and st["total_volume|bus|p90"] == 1.0   # T13
    assert st["total_volume|ind|median"] == 2.0


def _kyc(spark):
    ind = spark.createDataFrame([(1, 50000.0, 41101, dt.date(1980, 1, 1), dt.date(2024, 1, 1)),
                                 (2, None, 12345, None, None),
                                 (3, 10.0, 63101, None, None), (3, 10.0, 63101, None, None)],
                                "customer_id long, income double, occupation_code int, birth_date date, onboard_date date")
    bus = spark.createDataFrame([(3, 100000.0, 6561, 2.0, "2010-01-01")],
                                "customer_id long, sales double, industry_code int, employee_count double, "
                                "established_date string")
    occ = spark.createDataFrame([("41101", "lawyer"), ("12345", "x"), ("63101", "agent")],
                                "occupation_code string, occupation_title string")
    ind_codes = spark.createDataFrame([("6561", "jewellery")], "industry_code string, industry string")
    return attach_kyc_risk_tiers(ind, bus, occ, ind_codes)


def test_kyc_types_dedupe_and_tiers(spark):
    ki, kb = _kyc(spark)
    assert ki.where("customer_id = 3").count() == 1                     # duplicate KYC row removed (T17)
    feats = spark.createDataFrame([(1,), (2,), (3,), (4,)], "customer_id long")
    out = {r["customer_id"]: r for r in kyc_features(feats, ki, kb, "2024-12-31").collect()}
    assert out[1]["customer_type"] == "individual" and out[1]["occupation_risk_high"] == 1
    assert out[2]["customer_type"] == "unknown"                        # KYC row, NULL income (T15)
    assert out[3]["customer_type"] == "business" and out[3]["industry_risk_high"] == 1  # sales wins (T15)
    assert out[4]["customer_type"] == "unknown" and out[4]["occupation_risk_high"] == 0
    assert out[1]["customer_tenure_days"] == 365.0                     # as_of, not now() (T14)


def test_imputation_both_ways(spark):
    df = spark.createDataFrame([(1, 10.0), (2, None), (3, 30.0), (4, 50.0)], "customer_id long, income double")
    med = C.impute_medians(df, ["income"])
    assert med["income"] == 30.0
    filled = {r["customer_id"]: r["income"] for r in C.with_imputation(df, med).collect()}
    assert filled[2] == 30.0                                           # T12: median by default
    assert df.where("customer_id = 2").first()["income"] is None       # impute=False keeps NULL


def test_argmax_first_column_wins(spark):
    df = spark.createDataFrame([(0.5, 0.5, 0.1)], "a double, b double, c double")
    assert df.select(argmax_label(["a", "b", "c"], ["A", "B", "C"]).alias("x")).first()["x"] == "A"  # T21


def test_constant_final_score_is_null(spark):
    ids = [1, 2]
    anom = spark.createDataFrame([(i, None, *[0.5] * 5, 0.5, 0.5, "t") for i in ids],
                                 "customer_id long, actual_label int, " +
                                 ", ".join(f"if_score_{t} double" for t in K.TYPOLOGIES) +
                                 ", if_score_max double, if_score_mean double, primary_typology string")
    rules = spark.createDataFrame([(i, *[0.0] * 5, 0.0, 0) for i in ids],
                                  "customer_id long, " + ", ".join(f"rule_{t} double" for t in K.TYPOLOGIES) +
                                  ", rule_score_weighted double, rules_triggered int")
    peers = spark.createDataFrame([(i, 0, 0.1, "General — Low Risk", 0.0) for i in ids],
                                  "customer_id long, cluster int, cluster_risk_tier double, "
                                  "cluster_primary_typology string, kmeans_score double")
    h = FU.fuse(anom, rules, peers).collect()
    assert all(r["final_hybrid_score"] is None for r in h)             # T20: no division error
    assert all(r["coverage"] == 0.0 for r in h)


def test_log_transform_skips_negative_columns(spark):
    df = spark.createDataFrame([(1, -5.0, 3.0), (2, 4.0, 0.0)], "customer_id long, net_flow double, total_volume double")
    assert log_columns(df, {"x": ["net_flow", "total_volume"]}) == {"total_volume"}   # T25
    _ = F


def test_time_span_of_unreadable_timestamps_is_the_median(spark):
    df = spark.createDataFrame([(1, 10), (2, 21), (3, None)], "customer_id long, time_span_days long")
    filled = C.with_imputation(df, C.impute_medians(df, ["time_span_days"]))
    assert {r.customer_id: r.time_span_days for r in filled.collect()} == {1: 10, 2: 21, 3: 16}
    assert filled.schema["time_span_days"].dataType.simpleString() == "bigint"
