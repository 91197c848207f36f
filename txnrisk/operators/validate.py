"""Validation and reporting operators over a scored customer table.

ROC-AUC uses the rank-sum form with mid-ranks, computed from per-score
(positive, negative) counts: ``sum_s pos(s) * (neg_below(s) + neg(s)/2) /
(P * N)``. ``neg_below`` is a running total over distinct scores from
``ranking`` (no single-task window). Top-k reports rank with the same
range-partitioned ranking; cut-offs enter as literals from a one-row count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import ordinal_rank, running_total


def roc_auc(df: DataFrame, label: str, scores: list[str]) -> DataFrame:
    """One row per score column: auc (0.0 when a class is missing), n_pos, n_neg."""
    lab = df.where(F.col(label).isNotNull())
    long = lab.select(F.col(label).cast("int").alias("y"), F.explode(F.array(*[
        F.struct(F.lit(s).alias("score"), F.col(s).cast("double").alias("v")) for s in scores])).alias("x")
    ).select("y", "x.score", "x.v")
    per = long.groupBy("score", "v").agg(
        F.sum(F.when(F.col("y") == 1, 1).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col("y") == 0, 1).otherwise(0)).alias("neg"))
    cum = running_total(per, [F.col("v").asc_nulls_first()], ["score"], F.col("neg"), "neg_cum")
    terms = cum.withColumn("term", F.col("pos") * (F.col("neg_cum") - F.col("neg") + F.col("neg") / 2.0))
    agg = terms.groupBy("score").agg(F.sum("term").alias("t"), F.sum("pos").alias("n_pos"),
                                     F.sum("neg").alias("n_neg"))
    return agg.select("score",
                      F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0),
                             F.col("t") / (F.col("n_pos") * F.col("n_neg")).cast("double"))
                       .otherwise(F.lit(0.0)).alias("auc"),
                      F.col("n_pos").cast("long").alias("n_pos"), F.col("n_neg").cast("long").alias("n_neg"))


def ranked(df: DataFrame, score: str, key: str = "customer_id") -> DataFrame:
    """Global 1-based rank, highest score first, ties by key."""
    return ordinal_rank(df, [F.col(score).desc_nulls_last(), F.col(key).asc()])


def capture_at_k(df: DataFrame, label: str, score: str, pcts=(0.01, 0.05, 0.10)) -> DataFrame:
    """Positives inside the top int(n * pct) ranks, per pct."""
    n = df.count()
    cutoffs = [(float(p), int(n * p)) for p in pcts]
    r = ranked(df.select("customer_id", label, score), score).where(F.col(label) == 1)
    agg = r.agg(F.count(F.lit(1)).alias("positives"),
                *[F.count(F.when(F.col("rank") <= c, 1)).alias(f"c{i}") for i, (_, c) in enumerate(cutoffs)])
    rows = F.explode(F.array(*[
        F.struct(F.lit(p).alias("pct"), F.lit(c).cast("long").alias("cutoff"), F.col(f"c{i}").alias("captured"))
        for i, (p, c) in enumerate(cutoffs)])).alias("x")
    return agg.select("positives", rows).select("x.pct", "x.cutoff", "x.captured", "positives")


def top_n(df: DataFrame, score: str, n: int, key: str = "customer_id") -> DataFrame:
    """The n highest-scored rows (ties by key) with their rank, from the
    distributed rank whatever n is."""
    return ranked(df, score, key).where(F.col("rank") <= n)


def grounding_lift(df: DataFrame, score: str, feats: list[str], top: int = 50) -> DataFrame:
    """Mean of each feature among the top rows vs the whole population,
    ratio = top / (population + 1e-9), flag ✓ > 3, ? > 1.5, else ✗."""
    if not feats:
        return df.sparkSession.createDataFrame([], "feature string, top_mean double, population_mean double, "
                                                  "ratio double, flag string")
    t = top_n(df.select("customer_id", score, *feats), score, top).agg(*[F.avg(f).alias(f) for f in feats])
    p = df.agg(*[F.avg(f).alias(f) for f in feats])
    tl = t.select(F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("top_mean"))
                                      for f in feats])).alias("x")).select("x.*")
    pl = p.select(F.explode(F.array(*[F.struct(F.lit(f).alias("feature"),
                                               F.col(f).cast("double").alias("population_mean"))
                                      for f in feats])).alias("x")).select("x.*")
    j = tl.join(pl, "feature")
    ratio = F.col("top_mean") / (F.col("population_mean") + F.lit(1e-9))
    return j.withColumn("ratio", ratio).withColumn(
        "flag", F.when(F.col("ratio") > 3, "✓").when(F.col("ratio") > 1.5, "?").otherwise("✗"))


def missing_columns(df: DataFrame, expected: list[str]) -> list[str]:
    """Expected columns absent from a table (reported, not fatal: missing
    features read as 0 in the rules)."""
    have = set(df.columns)
    return [c for c in expected if c not in have]
