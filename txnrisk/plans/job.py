"""The whole chain over a folder of exports, as one job.

    spark-submit -m txnrisk.plans.job EXPORTS RESULTS [AS_OF]

reads the exports (``sources.exports``) and writes, under RESULTS: rejects,
features, rules, scores (all and high risk), labels, evidence, request
records, payloads and narratives as parquet, and the explanations as CSV.
"""

from __future__ import annotations

import sys
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..operators import anomaly as AN
from ..operators import evidence as EV
from ..operators import fusion as FU
from ..operators import models as MO
from ..operators import peers as PE
from ..operators import rules as R
from ..operators import trace as TR
from ..session import write_stage_table
from ..sources import sinks as SK
from ..sources.channels import clean_transactions, unify_transactions
from ..sources.exports import dated, read_exports
from . import pipeline as P


def export_inputs(spark: SparkSession, directory: str, as_of: str | None = None) -> tuple[P.Inputs, DataFrame]:
    """Inputs from a folder of exports, and the records set aside."""
    found = read_exports(spark, directory)
    t = found.tables
    txn = clean_transactions(unify_transactions(found.channels))
    return P.Inputs(txn=P.stage_transactions(txn),
                    kyc_ind=dated(t["kyc_individual"], "birth_date", "onboard_date"), kyc_bus=t["kyc_smallbusiness"],
                    occupation_codes=t["kyc_occupation_codes"], industry_codes=t["kyc_industry_codes"],
                    labels=t["labels"], as_of=as_of or date.today().isoformat()), found.rejects


def peers_of(clustered: DataFrame) -> DataFrame:
    """Tier, typology and percentile of each customer's cluster."""
    profile = PE.cluster_profile(clustered).select("cluster", "cluster_risk_tier", "cluster_primary_typology")
    return PE.peer_percentile(clustered).join(F.broadcast(profile), "cluster").select(  # a row per cluster
        "customer_id", "cluster", "cluster_risk_tier", "cluster_primary_typology", "kmeans_score")


def with_trace_items(queue: DataFrame, rules: DataFrame) -> DataFrame:
    """The queue with its indicator traces as arrays."""
    points = [R.indicator_column_name(t, i) for _, t, i in R.indicator_ids()]
    q = queue.join(rules.select("customer_id", *[F.col(f"`{c}`") for c in points]), "customer_id")
    return q.withColumn("rule_indicator_trace_items", TR.trace_array()).drop(*points)


def run_job(spark: SparkSession, source: str, out: str, as_of: str | None = None, trees: int = K.FOREST_TREES,
            min_cluster: int = K.KMEANS_MIN_CLUSTER, restarts: int = K.KMEANS_RESTARTS) -> None:
    """Read, score and explain; see the module."""
    out = out.rstrip("/")

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{out}/{name}")
        return spark.read.schema(df.schema).parquet(f"{out}/{name}")

    inputs, rejects = export_inputs(spark, source, as_of)
    kept(rejects, "rejects")
    features = kept(P.feature_table(inputs), "features")
    rules = kept(TR.with_indicator_trace(R.with_rule_summary(R.rule_points(features))), "rules")
    model = MO.scoring_pipeline(trees, min_cluster, restarts).fit(features)
    model.write().overwrite().save(f"{out}/models")
    scored = kept(model.transform(features).select("customer_id", *PE.IF_COLS, F.col("prediction").cast("int").alias("cluster")),
                  "anomaly_scores")
    clusters = scored.select("customer_id", "cluster")
    anomaly = AN.with_score_rollup(scored.drop("cluster")).join(features.select("customer_id", F.col("label").alias("actual_label")), "customer_id")
    hybrid = write_stage_table(FU.fuse(anomaly, rules, peers_of(anomaly.join(clusters, "customer_id"))), "hybrid")
    SK.write_results(hybrid, f"{out}/scores", "final_hybrid_score")
    kept(FU.predicted_labels(hybrid), "labels")
    evidence = kept(FU.evidence(hybrid, rules), "evidence")
    queue = write_stage_table(with_trace_items(EV.queue(evidence, K.NARRATIVE_QUEUE), rules), "queue")
    records = kept(EV.request_records(queue), "requests")
    kept(EV.batch_payloads(records), "payloads")
    narratives = kept(EV.narratives(queue), "narratives")
    SK.write_explanations(narratives.select("customer_id", F.col("narrative").alias("explanation")), f"{out}/explanations")


def main(args: list[str]) -> None:
    if len(args) not in (2, 3):
        sys.exit(__doc__)
    from ..session import get_spark

    run_job(get_spark(app="txnrisk-job"), *args)


if __name__ == "__main__":
    main(sys.argv[1:])
