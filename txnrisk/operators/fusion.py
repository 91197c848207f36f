"""Score fusion: rule x anomaly agreement, anomaly fallback, peer pillar.

All projections; the population min / max come from one-row aggregates and
enter the plan as literals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..session import write_stage_table
from ..functions.columns import argmax_label, bool_int, risk_band
from .quantiles import QSpec, exact_quantiles

IF_COLS = [f"if_score_{t}" for t in K.TYPOLOGIES]
RULE_COLS = [f"rule_{t}" for t in K.TYPOLOGIES]
DYN_COLS = [f"dynamic_{t}" for t in K.TYPOLOGIES]


def _sum(cols: list[Column]) -> Column:
    s = cols[0]
    for c in cols[1:]:
        s = s + c
    return s


def _lit(v) -> Column:
    """A value of a one-row aggregate as a typed literal (NULL stays NULL)."""
    return F.lit(v).cast("double")


def if_score_weighted() -> Column:
    return _sum([F.col(f"if_score_{t}") * K.TYPOLOGY_WEIGHTS[t] for t in K.TYPOLOGIES])


def with_dynamic_scores(pre: DataFrame) -> DataFrame:
    """dynamic_t = if_t * rule_t, raw sum, min-max (+1e-9) and the
    dynamic argmax as primary rule typology."""
    d = pre.select("*", *[(F.col(f"if_score_{t}") * F.col(f"rule_{t}")).alias(f"dynamic_{t}")
                          for t in K.TYPOLOGIES])
    d = d.withColumn("dynamic_score_raw", _sum([F.col(c) for c in DYN_COLS]))
    d = write_stage_table(d, "dynamic-scores")  # joined once, read for the range and for the scores
    mm = d.agg(F.min("dynamic_score_raw").alias("lo"), F.max("dynamic_score_raw").alias("hi")).first()
    lo, hi = _lit(mm["lo"]), _lit(mm["hi"])
    return (d.withColumn("dynamic_score_norm", (F.col("dynamic_score_raw") - lo) / (hi - lo + F.lit(1e-9)))
             .withColumn("primary_rule_typology",
                         argmax_label(DYN_COLS, [K.TYPOLOGY_LABELS[t] for t in K.TYPOLOGIES])))


def fuse(anomaly: DataFrame, rules: DataFrame, peers: DataFrame) -> DataFrame:
    """anomaly: customer_id, if_score_*, if_score_max, if_score_mean,
    primary_typology, actual_label. rules: customer_id, rule_*,
    rule_score_weighted, rules_triggered. peers: customer_id, cluster,
    cluster_risk_tier, cluster_primary_typology, kmeans_score."""
    pre = (anomaly.withColumn("if_score_weighted", if_score_weighted())
                  .join(rules.select("customer_id", *RULE_COLS, "rule_score_weighted", "rules_triggered"),
                        "customer_id", "inner"))
    h = with_dynamic_scores(pre).join(peers, "customer_id", "inner")
    coverage = _sum([bool_int(F.col(c) > 0).cast("double") for c in RULE_COLS]) / float(len(RULE_COLS))
    h = (h.withColumn("coverage", coverage)
          .withColumn("adjusted_kmeans_score", F.col("kmeans_score") * F.col("cluster_risk_tier")))
    raw = (F.lit(K.PILLAR_DYNAMIC) * F.col("dynamic_score_norm") +
           F.lit(K.PILLAR_FALLBACK) * (F.lit(1.0) - F.col("coverage")) * F.col("if_score_weighted") +
           F.lit(K.PILLAR_PEER) * F.col("adjusted_kmeans_score"))
    h = write_stage_table(h.withColumn("final_raw", raw), "final-raw")
    mm = h.agg(F.min("final_raw").alias("lo"), F.max("final_raw").alias("hi")).first()
    lo, hi = _lit(mm["lo"]), _lit(mm["hi"])
    # no epsilon here: constant scores give NULL (division by zero guarded)
    h = h.withColumn("final_hybrid_score", F.try_divide(F.col("final_raw") - lo, hi - lo))
    return (h.withColumn("hybrid_risk_category", risk_band(F.col("final_hybrid_score")))
             .drop("final_raw"))


HYBRID_COLUMNS = (
    ["customer_id", "actual_label", *IF_COLS, "if_score_weighted", "if_score_max", "if_score_mean",
     "primary_typology", *RULE_COLS, "rule_score_weighted", "rules_triggered", "primary_rule_typology",
     *DYN_COLS, "dynamic_score_raw", "dynamic_score_norm", "cluster", "cluster_risk_tier",
     "cluster_primary_typology", "kmeans_score", "adjusted_kmeans_score", "coverage",
     "final_hybrid_score", "hybrid_risk_category"]
)


def predicted_labels(hybrid: DataFrame, q: float = 0.99) -> DataFrame:
    """predicted_label = 1 when the score is at or above its population p99."""
    thr = exact_quantiles(hybrid, [QSpec("t", "final_hybrid_score", q)])["t"]
    thr_c = F.lit(thr).cast("double") if thr is not None else F.lit(None).cast("double")
    return hybrid.select("customer_id",
                         bool_int(F.col("final_hybrid_score") >= thr_c).alias("predicted_label"),
                         F.col("final_hybrid_score").alias("risk_score"))


EVIDENCE_COLUMNS = (
    ["customer_id", "final_hybrid_score", "hybrid_risk_category", "coverage", "cluster_primary_typology",
     "primary_rule_typology", "if_score_weighted", "if_score_max", "dynamic_score_norm", "dynamic_score_raw",
     "rule_score_weighted", "rules_triggered", "cluster_risk_tier", "kmeans_score", "adjusted_kmeans_score",
     "rule_indicator_trace", *IF_COLS, *RULE_COLS, *DYN_COLS]
)


def evidence(hybrid: DataFrame, trace: DataFrame, threshold: float = K.EVIDENCE_SCORE) -> DataFrame:
    """Customers above the evidence threshold with the columns an analyst
    needs; the indicator trace comes from the rule stage (left join)."""
    h = hybrid
    if "rule_indicator_trace" not in h.columns:
        h = h.join(trace.select("customer_id", "rule_indicator_trace"), "customer_id", "left")
    return h.where(F.col("final_hybrid_score") > threshold).select(*EVIDENCE_COLUMNS)
