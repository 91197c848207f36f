"""Customer-level tables are bucketed: joins on the customer shuffle nothing."""

import re

import pytest

from txnrisk.operators import fusion as FU
from txnrisk.plans import pipeline as P
from txnrisk.plans import queries as Q

SF = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    was = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, was)


def exchanges(df):
    return re.findall(r"Exchange \w+\([^)]*\)", df._jdf.queryExecution().executedPlan().toString())


def test_joins_on_customers_need_no_shuffle(spark, no_broadcast):
    features, rules = Q.features(spark, SF), Q.rule_table(spark, SF)
    joined = features.select("customer_id", "total_volume").join(rules.select("customer_id", "rules_triggered"), "customer_id")
    assert exchanges(joined) == [] and joined.count() == features.count()
    hybrid = Q.standin_hybrid(spark, SF)
    assert exchanges(FU.evidence(hybrid.drop("rule_indicator_trace"), rules)) == []
    peers = P.materialize(hybrid.select("customer_id", "cluster", "cluster_risk_tier", "cluster_primary_typology", "kmeans_score"))
    anomaly = P.materialize(Q.standin_anomaly(spark, SF))
    assert exchanges(FU.fuse(anomaly, rules, peers)) == []


def test_rows_are_kept(spark):
    df = spark.createDataFrame([(None, "a"), (1, "b"), (1, "b"), (2, None)], "customer_id long, x string")
    back = P.materialize(df)
    assert back.schema == df.schema and sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))
    assert P.materialize(df.limit(0)).count() == 0
    assert P.materialize(df.select("x")).count() == 4
