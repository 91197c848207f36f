"""Semantics traps on hand-made transactions."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from txnrisk.operators.features import behavioural_features
from txnrisk.sources.channels import with_time_columns

SCHEMA = T.StructType([
    T.StructField("customer_id", T.LongType()), T.StructField("amount_cad", T.DoubleType()),
    T.StructField("debit_credit", T.StringType()), T.StructField("transaction_datetime", T.TimestampNTZType()),
    T.StructField("country", T.StringType()), T.StructField("province", T.StringType()),
    T.StructField("city", T.StringType()), T.StructField("merchant_category", T.StringType()),
    T.StructField("ecommerce_ind", T.IntegerType()), T.StructField("cash_indicator", T.IntegerType()),
    T.StructField("channel", T.StringType()),
])
D = dt.datetime


def row(cid, amt, ts, channel="EFT", dc="D", country=None, city=None, mcc=None, ecom=None, cash=None, prov=None):
    return (cid, amt, dc, ts, country, prov, city, mcc, ecom, cash, channel)


@pytest.fixture(scope="module")
def feats(spark):
    rows = [
        # customer 1: null country on a non-card row is international (T1); one card row CA
        row(1, 100.0, D(2024, 1, 1, 10), "EFT"),
        row(1, 200.0, D(2024, 1, 2, 10), "Card", country="CA", mcc="5411.0"),
        # customer 2: single transaction -> std 0 (T4); 23.9 h gap case below
        row(2, 50.0, D(2024, 3, 4, 0, 0)),
        # customer 3: all-null amounts -> sums 0 (T3), counts 0, rows still counted (T5)
        row(3, None, D(2024, 1, 1, 1)), row(3, None, D(2024, 1, 1, 2)),
        # customer 4: gap of 23.9 h -> 0 days; then 48.5 h -> 2 days (T6)
        row(4, 10.0, D(2024, 1, 1, 0, 0)), row(4, 10.0, D(2024, 1, 1, 23, 54)), row(4, 10.0, D(2024, 1, 4, 0, 24)),
        # customer 5: Monday 2024-01-01 is weekday 0, Saturday 2024-01-06 is 5 (T7); NaT month (T8)
        row(5, 10.0, D(2024, 1, 1, 12)), row(5, 10.0, D(2024, 1, 6, 12)), row(5, 10.0, None),
        # customer 6: MCC text cut at '.', airline range inclusive 3000-3299 (T22)
        row(6, 1.0, D(2024, 1, 1), "Card", mcc="3000"), row(6, 1.0, D(2024, 1, 1), "Card", mcc="3299.0"),
        row(6, 1.0, D(2024, 1, 1), "Card", mcc="3300"), row(6, 1.0, D(2024, 1, 1), "Card", mcc="4511"),
        # customer 7: negatives and zero are below 10k; 0 is round (T23)
        row(7, -500.0, D(2024, 1, 1)), row(7, 0.0, D(2024, 1, 2)), row(7, 9999.99, D(2024, 1, 3)),
        # customer 8: card recency relative to own last card date (T16)
        row(8, 100.0, D(2024, 6, 30, 12), "Card"), row(8, 10.0, D(2024, 5, 31, 12), "Card"),
        row(8, 1.0, D(2024, 5, 30, 11), "Card"), row(8, 1000.0, D(2024, 12, 31), "EFT"),
    ]
    df = with_time_columns(spark.createDataFrame(rows, SCHEMA))
    return {r["customer_id"]: r for r in behavioural_features(df).collect()}


def test_null_country_is_international(feats):
    assert feats[1]["international_txn_count"] == 1
    assert feats[1]["international_ratio"] == 0.5


def test_single_transaction_std_zero(feats):
    assert feats[2]["std_transaction_amount"] == 0.0
    assert feats[2]["max_days_between_txns"] == 0
    assert feats[2]["time_span_days"] == 1


def test_all_null_amounts(feats):
    r = feats[3]
    assert r["transaction_count_total"] == 0 and r["total_volume"] == 0.0
    assert r["night_transaction_count"] == 2      # size counts rows
    assert r["avg_transaction_amount"] is None and r["median_transaction_amount"] is None


def test_elapsed_days_are_floored_24h(feats):
    assert feats[4]["max_days_between_txns"] == 2
    assert feats[4]["active_days"] == 2


def test_weekday_and_nat_month(feats):
    r = feats[5]
    assert r["weekend_transaction_count"] == 1
    # months: 2024-01 (2 rows) and 'NaT' (1 row) -> std of [2, 1]
    assert abs(r["monthly_txn_count_mean"] - 1.5) < 1e-12
    assert abs(r["monthly_txn_count_std"] - 0.7071067811865476) < 1e-12


def test_mcc_text_and_airline_range(feats):
    assert feats[6]["card_travel_count"] == 3
    assert feats[1]["card_retail_count"] == 1


def test_sub_threshold_includes_negatives_and_zero(feats):
    r = feats[7]
    assert r["count_below_10k"] == 3
    assert r["count_round_100"] == 2          # -500 and 0
    assert r["count_near_10k"] == 1


def test_card_recency_own_last_date(feats):
    r = feats[8]
    assert r["card_volume_30d"] == 110.0      # 30 days 0 h back is in, 31 days out
    assert r["card_volume_90d"] == 111.0


def test_distinct_counts_of_nulls_and_cards_without_an_expand(spark):
    from txnrisk.operators.features import distinct_counts

    rows = [(1, "Card", "CA", "p", "a"), (1, "Card", "CA", "q", "b"), (1, "Wire", "US", "p", "a"), (1, None, "MX", None, "c"),
            (2, "Wire", None, None, None), (3, "Card", None, "p", None), (None, "Card", "CA", "p", "a")]
    got = distinct_counts(spark.createDataFrame(rows, "customer_id long, channel string, country string, province string, city string"))
    assert {tuple(r) for r in got.collect()} == {(1, 3, 2, 3, 2, 1), (2, 0, 0, 0, 0, 0), (3, 0, 1, 0, 0, 0), (None, 1, 1, 1, 1, 1)}
    assert "Expand" not in got._jdf.queryExecution().toString()


def test_behavioural_features_are_computed_once_a_session(spark, monkeypatch):
    from txnrisk.plans import pipeline as P
    from txnrisk.plans import queries as Q

    calls, compute = [], P.behavioural_features
    counted = lambda txn: calls.append(1) or compute(txn)
    monkeypatch.setattr(P, "behavioural_features", counted)
    monkeypatch.setattr(Q.FE, "behavioural_features", counted)
    Q.reset()
    try:
        Q.behavioural(spark, "/root/testdata/sf0.001")
        Q.features(spark, "/root/testdata/sf0.001")
    finally:
        Q.reset()
    assert len(calls) == 1
