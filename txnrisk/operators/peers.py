"""Peer groups: KMeans over robust-scaled anomaly scores, cluster profiles
and within-cluster percentiles.

Clustering is MLlib's KMeans (``k-means||`` seeding, all rows), fitted once per
restart with its own seed; the fit of least cost is kept. The restarts share a
staged and cached table of one vector per customer and run as parallel jobs.
The thin-cluster loop lowers k to a floor until every cluster of the kept model
has at least ``min_size`` members; sizes come from the model's own summary.
Silhouettes are MLlib's, over all rows. Profiles are a ``groupBy`` + one-row
aggregate; percentiles use the range-partitioned rank from ``ranking`` (a
cluster can hold most customers, so no per-cluster window).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.columns import argmax_label
from ..session import write_stage_table
from .anomaly import robust_params, robust_scale
from .ranking import group_sizes, ordinal_rank

IF_COLS = [f"if_score_{t}" for t in K.TYPOLOGIES]


def peer_vectors(scores: DataFrame) -> DataFrame:
    """customer_id + the robust-scaled five scores as ``features`` vector, from
    a staged table of their columns."""
    mat = scores.select("customer_id", *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in IF_COLS])
    mat = write_stage_table(mat, "peer-scores")
    scaled = robust_scale(mat, robust_params(mat, IF_COLS))
    return VectorAssembler(inputCols=IF_COLS, outputCol="features").transform(scaled).select("customer_id", "features")


ROWS_A_PARTITION = 50_000


def fit_best(vectors: DataFrame, k: int, restarts: int = K.KMEANS_RESTARTS, seed: int = K.FOREST_SEED,
             threads: int = 8) -> KMeansModel:
    """One fit per seed, as parallel Spark jobs; the least training cost wins."""
    def fit(i: int):
        m = KMeans(k=k, seed=seed + i, initMode="k-means||", maxIter=300, tol=1e-4).fit(vectors)
        return m.summary.trainingCost, i, m

    with ThreadPoolExecutor(max_workers=max(1, threads)) as ex:
        fits = list(ex.map(fit, range(restarts)))
    return min(fits, key=lambda x: (x[0], x[1]))[2]


def choose_clusters(vectors: DataFrame, start_k: int = K.KMEANS_START_K, floor_k: int = K.KMEANS_K_FLOOR,
                    min_size: int = K.KMEANS_MIN_CLUSTER, restarts: int = K.KMEANS_RESTARTS,
                    seed: int = K.FOREST_SEED) -> tuple[KMeansModel, int]:
    """Fit k = start_k, start_k - 1, ... until the smallest cluster has at least
    ``min_size`` members; below the floor keep the floor's fit. A k of which
    ``min_size`` members each are more than there are needs no fit."""
    n = vectors.count()
    # every fit passes over it many times, with a task per partition
    vectors = vectors.coalesce(n // ROWS_A_PARTITION + 1).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for k in range(start_k, floor_k - 1, -1):
            if k > floor_k and n < k * min_size:
                continue
            model = fit_best(vectors, k, restarts, seed)
            if min(model.summary.clusterSizes) >= min_size:
                break
        return model, k
    finally:
        vectors.unpersist()


def assign_clusters(vectors: DataFrame, model: KMeansModel) -> DataFrame:
    return model.transform(vectors).select("customer_id", F.col("prediction").cast("int").alias("cluster"))


def silhouette_by_k(vectors: DataFrame, ks: list[int], restarts: int = 5, seed: int = K.FOREST_SEED) -> DataFrame:
    """Silhouette of the best of ``restarts`` fits per k, over all customers
    (the squared-Euclidean silhouette needs one pass, not all pairs)."""
    ev = ClusteringEvaluator(featuresCol="features", predictionCol="prediction", metricName="silhouette")
    vectors = vectors.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = [(k, float(ev.evaluate(fit_best(vectors, k, restarts, seed).transform(vectors)))) for k in ks]
    finally:
        vectors.unpersist()
    return vectors.sparkSession.createDataFrame(rows, "k int, silhouette double")


def cluster_profile(scored: DataFrame) -> DataFrame:
    """Per cluster: size, mean of each score, label (argmax of the means, or
    the general low-risk label when every mean is below 0.20) and risk tier
    0.1 + 0.9 * scaled mean of ``if_score_mean`` across clusters."""
    prof = scored.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n_customers"),
        *[F.avg(c).alias(c) for c in IF_COLS],
        F.avg("if_score_mean").alias("cluster_if_mean"))
    top = F.greatest(*[F.col(c) for c in IF_COLS])
    label = F.when(top < K.CLUSTER_LOW_RISK_CUTOFF, F.lit(K.GENERAL_LOW_RISK_LABEL)).otherwise(
        argmax_label(IF_COLS, [K.TYPOLOGY_LABELS[t] for t in K.TYPOLOGIES]))
    mm = prof.agg(F.min("cluster_if_mean").alias("lo"), F.max("cluster_if_mean").alias("hi")).first()
    lo, hi = F.lit(mm["lo"]).cast("double"), F.lit(mm["hi"]).cast("double")   # one row per cluster above
    return (prof.withColumn("cluster_primary_typology", label)
                .withColumn("cluster_risk_tier",
                            F.lit(0.1) + F.lit(0.9) * (F.col("cluster_if_mean") - lo) / (hi - lo + F.lit(1e-9))))


def peer_percentile(scored: DataFrame) -> DataFrame:
    """Within-cluster ordinal rank of ``if_score_mean`` scaled to [0, 1]
    (ties broken by customer id)."""
    r = ordinal_rank(scored.select("customer_id", "cluster", "if_score_mean"),
                     [F.col("if_score_mean").asc(), F.col("customer_id").asc()], ["cluster"])
    r = group_sizes(r, ["cluster"], "cluster_size")
    return r.withColumn("kmeans_score", (F.col("rank") - 1) /
                        F.greatest(F.col("cluster_size") - 1, F.lit(1)).cast("double"))
