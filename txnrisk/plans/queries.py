"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables (through the fixture mapping) so its
work grows with them. Results go through ``present`` so they compare
value-for-value with the DuckDB oracle.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..operators import composites as C
from ..operators import features as FE
from ..operators.kyc import attach_kyc_risk_tiers
from ..sources import fixtures as FX
from ..sources.channels import unify_transactions, with_time_columns
from . import pipeline as P
from .job import export_inputs, peers_of, with_trace_items
from .present import present
from .stages import memo

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------------------
# shared stages
# ---------------------------------------------------------------------------

def inputs(spark: SparkSession, sf_dir: str) -> P.Inputs:
    return memo(spark, sf_dir, "inputs", lambda: P.fixture_inputs(spark, sf_dir))


def behavioural(spark: SparkSession, sf_dir: str) -> DataFrame:
    return memo(spark, sf_dir, "behavioural",
                lambda: P.materialize(FE.behavioural_features(inputs(spark, sf_dir).txn)))


def customer_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return memo(spark, sf_dir, "customer_base", lambda: P.materialize(
        P.customer_base(inputs(spark, sf_dir), behavioural(spark, sf_dir))))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return memo(spark, sf_dir, "features", lambda: P.feature_table(
        inputs(spark, sf_dir), base=customer_base(spark, sf_dir)))


def _block(cols: list[str]) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(behavioural(spark, sf_dir).select("customer_id", *cols))
    return q


# ---------------------------------------------------------------------------
# sources
# ---------------------------------------------------------------------------

def channel_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Per-channel source tables, each read from its own partition of the
    staged transaction table (partition pruning, no recomputation)."""
    return FX.split_channels(inputs(spark, sf_dir).txn)


@register("unify_transactions")
def q_unify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-channel tables -> rename/pad -> union -> derived time columns."""
    t = with_time_columns(unify_transactions(channel_tables(spark, sf_dir)))
    return present(t)


@register("src_channel_scan")
def q_channel_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = unify_transactions(channel_tables(spark, sf_dir))
    return present(t.groupBy("channel").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("customer_id").alias("n_customers"),
        F.sum("amount_cad").alias("total_amount"),
        F.count(F.when(F.col("country").isNull(), 1)).alias("null_country_count"),
        F.min("transaction_datetime").alias("first_transaction_date"),
        F.max("transaction_datetime").alias("last_transaction_date")))


# ---------------------------------------------------------------------------
# feature blocks
# ---------------------------------------------------------------------------

REGISTRY["volume_features"] = _block([
    "transaction_count_total", "total_volume", "avg_transaction_amount", "median_transaction_amount",
    "std_transaction_amount", "min_transaction_amount", "max_transaction_amount",
    "first_transaction_date", "last_transaction_date", "active_days"])
REGISTRY["flow_features"] = _block([
    "transaction_count_debit", "total_outflow", "transaction_count_credit", "total_inflow", "net_flow",
    "inflow_outflow_ratio", "amount_cv", "time_span_days", "transactions_per_day",
    "transactions_per_active_day", "volume_per_day", "inflow_per_day", "outflow_per_day",
    "flow_through_ratio"])
REGISTRY["gap_features"] = _block(["max_days_between_txns", "time_span_days", "active_days"])
REGISTRY["structuring_features"] = _block(FE.STRUCTURING_COLUMNS)
REGISTRY["channel_features"] = _block([c for c in FE.CHANNEL_COLUMNS if c != "channel_concentration_hhi"])
REGISTRY["channel_hhi"] = _block(["channel_concentration_hhi", "unique_channels"])
REGISTRY["card_mcc_features"] = _block([c for c in FE.CARD_COLUMNS if "30d" not in c and "90d" not in c])
REGISTRY["card_recency_features"] = _block(["card_volume_30d", "card_volume_90d", "card_30d_ratio",
                                            "card_90d_ratio"])
REGISTRY["eft_emt_features"] = _block(FE.EFT_EMT_COLUMNS)
REGISTRY["geo_features"] = _block(FE.GEO_COLUMNS)
REGISTRY["temporal_features"] = _block(FE.TEMPORAL_COLUMNS[:7])
REGISTRY["monthly_features"] = _block(FE.TEMPORAL_COLUMNS[7:])


@register("kyc_risk_tiers")
def q_kyc_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    inp = inputs(spark, sf_dir)
    ki, kb = attach_kyc_risk_tiers(inp.kyc_ind, inp.kyc_bus, inp.occupation_codes, inp.industry_codes)
    a = ki.select("customer_id", F.lit("individual").alias("kind"),
                  F.col("occupation_code").cast("long").alias("code"),
                  F.col("occupation_risk_high").alias("risk_high"),
                  F.lit(0).alias("ht_accommodation_sector"))
    b = kb.select("customer_id", F.lit("business").alias("kind"),
                  F.col("industry_code").cast("long").alias("code"),
                  F.col("industry_risk_high").alias("risk_high"), "ht_accommodation_sector")
    return present(a.unionByName(b))


@register("kyc_features")
def q_kyc_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.kyc import KYC_COLUMNS
    return present(customer_base(spark, sf_dir).select("customer_id", *KYC_COLUMNS))


@register("segment_ratios")
def q_segment_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = customer_base(spark, sf_dir)
    f = C.with_profile_ratios(C.with_segment_ratios(f, C.segment_stats(f)))
    return present(f.select("customer_id", *C.SEGMENT_COLUMNS, "spending_to_income_ratio",
                            "volume_to_sales_ratio", "income_vol_ratio"))


def _pre_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build():
        f = customer_base(spark, sf_dir)
        f = C.with_profile_ratios(C.with_segment_ratios(f, C.segment_stats(f)))
        for c in C.COMPOSITE_INPUTS:
            f = f.withColumn(c, F.coalesce(F.col(c), F.lit(0.0)))
        return P.materialize(f)
    return memo(spark, sf_dir, "pre_composite", build)


@register("population_p99")
def q_population_p99(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p99 of every normalised column (safe fallback 1.0), one row per column."""
    p99 = C.population_p99(_pre_composite(spark, sf_dir))
    rows = [(c, float(v)) for c, v in p99.items()]
    return present(spark.createDataFrame(rows, "feature string, p99 double"))


@register("impute_features")
def q_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Population medians used for imputation, with the number of NULLs each fills."""
    f = C.with_composites(_pre_composite(spark, sf_dir), C.population_p99(_pre_composite(spark, sf_dir)))
    med = C.impute_medians(f)
    nulls = f.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in C.MEDIAN_IMPUTED]).first()
    rows = [(c, med[c], int(nulls[c])) for c in C.MEDIAN_IMPUTED]
    return present(spark.createDataFrame(rows, "feature string, median double, null_count long"))


@register("composite_scores")
def q_composites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(features(spark, sf_dir).select("customer_id", *C.COMPOSITE_COLUMNS))


@register("feature_table")
def q_feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(features(spark, sf_dir))


# FIXED VALUES: composite inputs whose NULLs are counted
NULL_CHECKED = ["spending_to_income_ratio", "volume_to_sales_ratio", "income_vol_ratio", "monthly_volume_cv",
                "amount_cv", "flow_through_ratio", "ratio_round_100", "transactions_per_active_day"]


@register("data_quality")
def q_data_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row and customer counts per channel, NULL counts of the composite
    inputs, and the top 20 card merchant categories."""
    t = inputs(spark, sf_dir).txn
    per_ch = t.groupBy("channel").agg(F.count(F.lit(1)).alias("v")).select(
        F.lit("rows").alias("metric"), F.col("channel").alias("item"), F.col("v").cast("double").alias("value"))
    cust = t.agg(F.count_distinct("customer_id").alias("v")).select(
        F.lit("customers").alias("metric"), F.lit("all").alias("item"), F.col("v").cast("double").alias("value"))
    mcc = (t.where(F.col("channel") == "Card").groupBy(FE.mcc_code().alias("item")).count()
            .orderBy(F.desc("count"), F.asc("item")).limit(20)
            .select(F.lit("top_mcc").alias("metric"), "item", F.col("count").cast("double").alias("value")))
    base = customer_base(spark, sf_dir)
    base = C.with_profile_ratios(C.with_segment_ratios(base, C.segment_stats(base)))
    nulls_row = base.agg(*[
        F.count(F.when(F.col(c).isNull(), 1)).alias(c)
        for c in NULL_CHECKED])
    nulls = nulls_row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("item"), F.col(c).cast("double").alias("value")) for c in nulls_row.columns
    ])).alias("x")).select(F.lit("null_inputs").alias("metric"), "x.item", "x.value")
    return present(per_ch.unionByName(cust).unionByName(mcc).unionByName(nulls))


def queries() -> dict[str, Query]:
    return dict(REGISTRY)




# ---------------------------------------------------------------------------
# rules and trace
# ---------------------------------------------------------------------------

from ..operators import rules as R  # noqa: E402
from ..operators import trace as TR  # noqa: E402


def ind_alias(ind: str) -> str:
    return ind.lower().replace("-", "_")


def rule_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indicator points + typology scores + summary + trace, one row per customer."""
    def build():
        pts = R.with_rule_summary(R.rule_points(features(spark, sf_dir)))
        return P.materialize(TR.with_indicator_trace(pts))
    return memo(spark, sf_dir, "rule_table", build)


def _rules_query(typ: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = R.typology_rule_scores(features(spark, sf_dir), typ)
        cols = [F.col(f"`{R.indicator_column_name(typ, i)}`").alias(ind_alias(i)) for i, _ in R.RULES[typ]]
        return present(t.select("customer_id", *cols, f"rule_{typ}"))
    return q


for _t in K.TYPOLOGIES:
    REGISTRY[f"rules_{_t}"] = _rules_query(_t)

RULE_SUMMARY_COLUMNS = [f"rule_{t}" for t in K.TYPOLOGIES] + [
    "rule_score_weighted", "rules_triggered", "primary_rule_typology"]


@register("rule_scores")
def q_rule_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(rule_table(spark, sf_dir).select("customer_id", *RULE_SUMMARY_COLUMNS))


@register("indicator_trace")
def q_indicator_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(rule_table(spark, sf_dir).select("customer_id", "rule_indicator_trace"))


@register("trace_counts")
def q_trace_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = rule_table(spark, sf_dir)
    counts = TR.trace_counts(F.col("rule_indicator_trace"))
    return present(t.select("customer_id", *[counts[x].alias(f"n_{x}") for x in K.TYPOLOGIES]))


@register("flagship")
def q_flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers with weighted rule score, typologies fired, primary
    typology and indicator trace, highest score first."""
    t = rule_table(spark, sf_dir)
    return (t.select("customer_id", "rule_score_weighted", "rules_triggered", "primary_rule_typology",
                     "rule_indicator_trace")
             .orderBy(F.desc("rule_score_weighted"), F.asc("customer_id")))


# ---------------------------------------------------------------------------
# anomaly stage
# ---------------------------------------------------------------------------

from ..operators import anomaly as AN  # noqa: E402
from ..operators import fusion as FU  # noqa: E402
from ..operators import peers as PE  # noqa: E402
from ..operators import validate as VA  # noqa: E402


def _feature_sets_long(spark: SparkSession, f: DataFrame) -> tuple[DataFrame, dict, set]:
    sets = AN.feature_sets(f)
    logged = AN.log_columns(f, sets)
    rows = [(t, i, c) for t in K.TYPOLOGIES for i, c in enumerate(sets[t])]
    return spark.createDataFrame(rows, "typology string, position int, feature string"), sets, logged


@register("feature_sets")
def q_feature_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resolved model inputs per typology with the data facts that drive the
    transform: non-null count, min, max and whether log1p applies."""
    f = features(spark, sf_dir)
    fs, sets, logged = _feature_sets_long(spark, f)
    cols = sorted({c for v in sets.values() for c in v})
    stats = f.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in cols])).alias("x")) \
        .groupBy("x.feature").agg(F.count("x.v").alias("n_nonnull"), F.min("x.v").alias("min_value"),
                                   F.max("x.v").alias("max_value"))
    out = fs.join(stats, "feature").withColumn(
        "is_log", F.col("feature").isin(sorted(logged)).cast("int"))
    return present(out.select("typology", "position", "feature", "is_log", "n_nonnull", "min_value", "max_value"))


def _prepared(spark: SparkSession, sf_dir: str, scale: bool) -> tuple[DataFrame, dict]:
    f = features(spark, sf_dir)
    sets = AN.feature_sets(f)
    mat = AN.prepare_matrix(f, sets, AN.log_columns(f, sets))
    if scale:
        names = [c for c in mat.columns if c != "customer_id"]
        mat = AN.robust_scale(mat, AN.robust_params(mat, names))
    return mat, sets


def _long_matrix(mat: DataFrame, sets: dict) -> DataFrame:
    items = [F.struct(F.lit(t).alias("typology"), F.lit(c).alias("feature"), F.col(f"{t}__{c}").alias("value"))
             for t in K.TYPOLOGIES for c in sets[t]]
    return mat.select("customer_id", F.explode(F.array(*items)).alias("x")).select("customer_id", "x.*")


@register("log_transform")
def q_log_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    mat, sets = _prepared(spark, sf_dir, scale=False)
    return present(_long_matrix(mat, sets))


@register("robust_scale")
def q_robust_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    mat, sets = _prepared(spark, sf_dir, scale=True)
    return present(_long_matrix(mat, sets))


def real_anomaly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return memo(spark, sf_dir, "anomaly",
                lambda: P.materialize(memo(spark, sf_dir, "fit_and_score",
                                           lambda: AN.fit_and_score(features(spark, sf_dir)))[0]))


@register("iforest_scores")
def q_iforest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Isolation-forest scores per typology (rows-only check)."""
    return present(real_anomaly(spark, sf_dir))


FIXED_TREES, FIXED_DEPTH, HASH_PRIME = 20, 7, 1_000_003


def fixed_hash(typology: int, tree: int, node: int, salt: int) -> int:
    x = (typology * 7919 + tree * 104_729 + node * 1_299_709 + salt * 15_485_863) % HASH_PRIME
    return x * x % HASH_PRIME


def fixed_forest(sets: dict[str, list[str]]) -> pd.DataFrame:
    """Trees that follow from hashes of their nodes' numbers (children of n are
    2 n + 1 and 2 n + 2) instead of data, for which any engine can compute the
    paths: every tenth node below the second level and all at the last are
    leaves of 1 to 4 rows."""
    rows = []
    for t, typology in enumerate(K.TYPOLOGIES):
        for tree in range(FIXED_TREES):
            level = [0]
            for depth in range(FIXED_DEPTH + 1):
                below = []
                for node in level:
                    leaf = depth == FIXED_DEPTH or (depth > 1 and fixed_hash(t, tree, node, 3) % 10 == 0)
                    size = 1 + fixed_hash(t, tree, node, 4) % 4 if leaf else 0
                    split = 12.0 * (fixed_hash(t, tree, node, 2) / HASH_PRIME) ** 2
                    rows.append((typology, tree, node, fixed_hash(t, tree, node, 1) % len(sets[typology]), split,
                                 2 * node + 1, 2 * node + 2, size, depth, int(leaf)))
                    below += [] if leaf else [2 * node + 1, 2 * node + 2]
                level = below
    nodes = pd.DataFrame(rows, columns=[c.split()[0] for c in AN.NODE_SCHEMA.split(", ")])
    # node numbers without gaps, as grown trees have them
    nodes = nodes.sort_values(["typology", "tree", "node"], ignore_index=True)
    new = {k: i for _, g in nodes.groupby(["typology", "tree"]) for i, k in enumerate(zip(g["typology"], g["tree"], g["node"]))}
    for side in ("left", "right", "node"):
        nodes[side] = [new.get(k, -1) for k in zip(nodes["typology"], nodes["tree"], nodes[side])]
    return nodes


@register("iforest_fixed_scores")
def q_iforest_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw scores of all customers under a forest that no training made: the
    scoring alone."""
    f = features(spark, sf_dir)
    sets = AN.feature_sets(f)
    mat = AN.prepare_matrix(f, sets, AN.log_columns(f, sets))
    raw = AN.score_forest(mat, sets, fixed_forest(sets), per_tree=K.FOREST_SAMPLE)
    return present(raw.select("customer_id", *[F.col(f"raw_{t}").alias(f"raw_score_{t}") for t in K.TYPOLOGIES]))


def standin_anomaly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic stand-in for the forest: if_score_t = composite score t."""
    f = features(spark, sf_dir)
    s = f.select("customer_id", F.col("label").alias("actual_label"),
                 *[F.col(f"{t}_risk").alias(f"if_score_{t}") for t in K.TYPOLOGIES])
    return AN.with_score_rollup(s)


@register("score_rollup")
def q_score_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(standin_anomaly(spark, sf_dir).select(
        "customer_id", "if_score_max", "if_score_mean", "primary_typology", "risk_category"))


# ---------------------------------------------------------------------------
# peers
# ---------------------------------------------------------------------------

def standin_clusters(anom: DataFrame) -> DataFrame:
    """Stand-in cluster: tenth of if_score_mean (0..9)."""
    return anom.withColumn("cluster", F.least(F.floor(F.col("if_score_mean") * 10).cast("int"), F.lit(9)))


@register("peer_profile")
def q_peer_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    prof = PE.cluster_profile(standin_clusters(standin_anomaly(spark, sf_dir)))
    return present(prof.select("cluster", "n_customers", *PE.IF_COLS, "cluster_if_mean",
                               "cluster_primary_typology", "cluster_risk_tier"))


@register("peer_percentile")
def q_peer_percentile(spark: SparkSession, sf_dir: str) -> DataFrame:
    pct = PE.peer_percentile(standin_clusters(standin_anomaly(spark, sf_dir)))
    return present(pct.select("customer_id", "cluster", "rank", "cluster_size", "kmeans_score"))


def real_model(spark: SparkSession, sf_dir: str) -> tuple:
    """The fitted cluster model with its k, and the vectors it was fitted on."""
    def build():
        vectors = PE.peer_vectors(real_anomaly(spark, sf_dir))
        return (*PE.choose_clusters(vectors), vectors)
    return memo(spark, sf_dir, "real_model", build)


def real_peers(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build():
        model, k, vectors = real_model(spark, sf_dir)
        return P.materialize(PE.assign_clusters(vectors, model).withColumn("k", F.lit(k)))
    return memo(spark, sf_dir, "real_peers", build)


@register("peer_clusters")
def q_peer_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KMeans cluster per customer with the thin-cluster refit (rows-only)."""
    return present(real_peers(spark, sf_dir))


@register("select_k")
def q_select_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silhouette per k over all customers (rows-only)."""
    vectors = PE.peer_vectors(real_anomaly(spark, sf_dir))
    return present(PE.silhouette_by_k(vectors, list(range(3, K.KMEANS_START_K + 1))))


# ---------------------------------------------------------------------------
# fusion and labels
# ---------------------------------------------------------------------------

def standin_hybrid(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build():
        anom = standin_anomaly(spark, sf_dir)
        peers = peers_of(standin_clusters(anom))
        return P.materialize(FU.fuse(anom, rule_table(spark, sf_dir), P.materialize(peers)))
    return memo(spark, sf_dir, "standin_hybrid", build)


def real_hybrid(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build():
        anom = AN.with_score_rollup(real_anomaly(spark, sf_dir)).join(
            features(spark, sf_dir).select("customer_id", F.col("label").alias("actual_label")), "customer_id")
        cl = real_peers(spark, sf_dir).select("customer_id", "cluster")
        clustered = anom.join(cl, "customer_id")
        return P.materialize(FU.fuse(anom, rule_table(spark, sf_dir), P.materialize(peers_of(clustered))))
    return memo(spark, sf_dir, "real_hybrid", build)


@register("fusion")
def q_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(standin_hybrid(spark, sf_dir).select(*FU.HYBRID_COLUMNS))


@register("hybrid_scores")
def q_hybrid_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The real end-to-end hybrid score (forest + KMeans), rows-only."""
    return present(real_hybrid(spark, sf_dir).select(*FU.HYBRID_COLUMNS))


@register("predicted_labels")
def q_predicted_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(FU.predicted_labels(standin_hybrid(spark, sf_dir)))


@register("ranked_scores")
def q_ranked_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = VA.ranked(standin_hybrid(spark, sf_dir).select("customer_id", "final_hybrid_score",
                                                       "hybrid_risk_category"), "final_hybrid_score")
    return present(r.select("customer_id", "rank", "final_hybrid_score", "hybrid_risk_category"))


@register("indicator_trace_dynamic")
def q_trace_dynamic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trace weighted by each typology's anomaly score (stand-in scores)."""
    pts = rule_table(spark, sf_dir)
    anom = standin_anomaly(spark, sf_dir).select("customer_id", *PE.IF_COLS)
    t = TR.with_indicator_trace(pts.drop("rule_indicator_trace").join(anom, "customer_id"), dynamic=True)
    return present(t.select("customer_id", "rule_indicator_trace"))


def evidence_table(spark: SparkSession, sf_dir: str, hybrid=standin_hybrid) -> DataFrame:
    return memo(spark, sf_dir, f"evidence-{hybrid.__name__}", lambda: P.materialize(
        FU.evidence(hybrid(spark, sf_dir), rule_table(spark, sf_dir))))


@register("evidence")
def q_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(evidence_table(spark, sf_dir))


# ---------------------------------------------------------------------------
# validation
# ---------------------------------------------------------------------------

AUC_SCORES = ["final_hybrid_score", "if_score_weighted", "if_score_max", "rule_score_weighted",
              "dynamic_score_norm", "adjusted_kmeans_score"]


@register("roc_auc")
def q_roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AUC of each score variant on labelled customers; ``is_best`` marks the
    best single typology anomaly score (first one on ties)."""
    h = standin_hybrid(spark, sf_dir)
    typ_scores = [f"if_score_{t}" for t in K.TYPOLOGIES]
    a = VA.roc_auc(h, "actual_label", AUC_SCORES + typ_scores)
    order = spark.createDataFrame([(s, i) for i, s in enumerate(typ_scores)], "score string, ord int")
    cand = a.join(F.broadcast(order), "score")  # five fixed rows
    best = cand.agg(F.max_by("score", F.struct(F.round("auc", 10), -F.col("ord"))).alias("best")).first()["best"]
    return present(a.withColumn("is_best", (F.col("score") == F.lit(best)).cast("int")))


@register("capture_at_k")
def q_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(VA.capture_at_k(standin_hybrid(spark, sf_dir), "actual_label", "final_hybrid_score"))


@register("positive_breakdown")
def q_positive_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = standin_hybrid(spark, sf_dir)
    r = VA.ranked(h.select("customer_id", "actual_label", "final_hybrid_score", "if_score_weighted",
                           "dynamic_score_norm", "coverage", "rule_score_weighted", "kmeans_score",
                           "cluster_risk_tier", "cluster_primary_typology"), "final_hybrid_score")
    return present(r.where(F.col("actual_label") == 1).drop("actual_label"))


# FIXED VALUES: features profiled for the top of each typology's ranking
GROUNDING_FEATURES = {
    "structuring_layering": ["count_near_10k", "flow_through_ratio", "ratio_round_100", "unique_cities"],
    "behavioural_profile": ["spending_to_income_ratio", "monthly_volume_cv", "card_30d_ratio", "income_vol_ratio"],
    "trade_shell": ["volume_to_sales_ratio", "trade_shell_risk", "flow_through_ratio", "employee_count"],
    "cross_border_geo": ["high_risk_fatf_txn_count", "international_ratio", "sum_westernunion",
                         "drug_country_txn_count"],
    "human_trafficking": ["card_adult_afterhours_count", "human_trafficking_risk",
                          "ht_source_country_txn_count", "card_luxury_sum"],
}


@register("grounding_lift")
def q_grounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = features(spark, sf_dir)
    anom = standin_anomaly(spark, sf_dir).select("customer_id", *PE.IF_COLS)
    j = f.join(anom, "customer_id")
    parts = []
    for t in K.TYPOLOGIES:
        g = VA.grounding_lift(j, f"if_score_{t}", GROUNDING_FEATURES[t], 50)
        parts.append(g.withColumn("typology", F.lit(t)))
    out = parts[0]
    for p_ in parts[1:]:
        out = out.unionByName(p_)
    return present(out.select("typology", "feature", "top_mean", "population_mean", "ratio", "flag"))


@register("topk_overlap")
def q_topk_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers shared by the top 1% of each pair of typologies."""
    anom = standin_anomaly(spark, sf_dir)
    n = anom.count()
    k = int(n * 0.01)
    tops = None
    for t in K.TYPOLOGIES:
        tt = VA.top_n(anom.select("customer_id", f"if_score_{t}"), f"if_score_{t}", k) \
            .select("customer_id", F.lit(t).alias("typology"))
        tops = tt if tops is None else tops.unionByName(tt)
    a, b = tops.alias("a"), tops.alias("b")
    pairs = a.join(b, "customer_id").where(F.col("a.typology") < F.col("b.typology"))
    counts = pairs.groupBy(F.col("a.typology").alias("typology_a"), F.col("b.typology").alias("typology_b")) \
        .agg(F.count(F.lit(1)).alias("overlap"))
    allp = spark.createDataFrame([(x, y) for i, x in enumerate(sorted(K.TYPOLOGIES))
                                  for y in sorted(K.TYPOLOGIES)[i + 1:]], "typology_a string, typology_b string")
    out = allp.join(counts, ["typology_a", "typology_b"], "left").select(
        "typology_a", "typology_b", F.coalesce("overlap", F.lit(0)).cast("long").alias("overlap"),
        F.lit(k).cast("long").alias("top_n"))
    return present(out)


@register("risk_distribution")
def q_risk_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = standin_hybrid(spark, sf_dir)
    a = h.groupBy(F.col("hybrid_risk_category").alias("item")).count().withColumn("kind", F.lit("hybrid_band"))
    anom = standin_anomaly(spark, sf_dir)
    b = anom.groupBy(F.col("risk_category").alias("item")).count().withColumn("kind", F.lit("anomaly_band"))
    top = VA.top_n(anom.select("customer_id", "if_score_max", "primary_typology"), "if_score_max", 1000)
    c = top.groupBy(F.col("primary_typology").alias("item")).count().withColumn("kind", F.lit("top1000_typology"))
    out = a.unionByName(b).unionByName(c)
    return present(out.select("kind", "item", F.col("count").alias("n")))


SUMMARY_SCORES = [*FU.RULE_COLS, "rule_score_weighted", "dynamic_score_raw", "dynamic_score_norm", "coverage",
                  "if_score_weighted", "kmeans_score", "adjusted_kmeans_score", "final_hybrid_score"]


@register("score_summary")
def q_score_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.quantiles import QSpec, exact_quantiles
    h = standin_hybrid(spark, sf_dir)
    qs = exact_quantiles(h, [QSpec(f"{s}|{p}", f"`{s}`", p) for s in SUMMARY_SCORES
                             for p in (0.25, 0.5, 0.75, 0.95)])
    base = h.agg(*[x for s in SUMMARY_SCORES for x in (
        F.avg(s).alias(f"{s}__mean"), F.max(s).alias(f"{s}__max"),
        F.count(F.when(F.col(s) > 0, 1)).alias(f"{s}__n_positive"))])
    items = []
    for s in SUMMARY_SCORES:
        items.append(F.struct(F.lit(s).alias("score"), F.col(f"{s}__mean").alias("mean"),
                              F.lit(qs[f"{s}|0.25"]).cast("double").alias("p25"),
                              F.lit(qs[f"{s}|0.5"]).cast("double").alias("p50"),
                              F.lit(qs[f"{s}|0.75"]).cast("double").alias("p75"),
                              F.lit(qs[f"{s}|0.95"]).cast("double").alias("p95"),
                              F.col(f"{s}__max").alias("max"),
                              F.col(f"{s}__n_positive").cast("long").alias("n_positive")))
    return present(base.select(F.explode(F.array(*items)).alias("x")).select("x.*"))


CORR_COMPONENTS = ["dynamic_score_norm", "if_score_weighted", "kmeans_score", "adjusted_kmeans_score",
                   "coverage", "rule_score_weighted"]


@register("component_correlation")
def q_component_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = standin_hybrid(spark, sf_dir)
    # Pearson r; a constant component has no correlation (NULL), not an error
    y = "final_hybrid_score"
    c = h.agg(*[F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y)).alias(x)
                for x in CORR_COMPONENTS])
    return present(c.select(F.explode(F.array(*[
        F.struct(F.lit(x).alias("score"), F.col(x).alias("correlation")) for x in CORR_COMPONENTS])).alias("y"))
        .select("y.*"))


# ---------------------------------------------------------------------------
# evidence queue, requests, responses, narratives
# ---------------------------------------------------------------------------

from ..operators import evidence as EV  # noqa: E402


def queue_table(spark: SparkSession, sf_dir: str, hybrid=standin_hybrid) -> DataFrame:
    """All evidence customers in rank order and batches, with their traces."""
    def build():
        return P.materialize(with_trace_items(EV.queue(evidence_table(spark, sf_dir, hybrid)), rule_table(spark, sf_dir)))
    return memo(spark, sf_dir, f"queue-{hybrid.__name__}", build)


@register("evidence_batches")
def q_evidence_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 600 evidence customers in batches of 300: size, rank span, ids in
    rank order and score span per batch."""
    q = queue_table(spark, sf_dir).where(F.col("rank") <= K.NARRATIVE_QUEUE)
    b = q.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n_customers"), F.min("rank").alias("first_rank"), F.max("rank").alias("last_rank"),
        F.array_sort(F.collect_list(F.struct("rank", F.col("customer_id").cast("string").alias("id")))).alias("ids"),
        F.min("final_hybrid_score").alias("min_score"), F.max("final_hybrid_score").alias("max_score"))
    return present(b.select("batch_id", "n_customers", "first_rank", "last_rank",
                            F.array_join(F.transform("ids", lambda x: x["id"]), ",").alias("customer_ids"),
                            "min_score", "max_score"))


@register("request_records")
def q_request_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(EV.request_records(queue_table(spark, sf_dir)))


def narratives_table(spark: SparkSession, sf_dir: str, hybrid=standin_hybrid) -> DataFrame:
    return memo(spark, sf_dir, f"narratives-{hybrid.__name__}",
                lambda: P.materialize(EV.narratives(queue_table(spark, sf_dir, hybrid))))


@register("narratives")
def q_narratives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(narratives_table(spark, sf_dir))


@register("narrative_checks")
def q_narrative_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(EV.narrative_checks(narratives_table(spark, sf_dir), queue_table(spark, sf_dir)))


def responses(spark: SparkSession, sf_dir: str, hybrid=standin_hybrid) -> DataFrame:
    return EV.synth_responses(narratives_table(spark, sf_dir, hybrid))


@register("parse_responses")
def q_parse_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(EV.parse_responses(responses(spark, sf_dir)))


@register("reconcile_responses")
def q_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = queue_table(spark, sf_dir)
    parsed = EV.parse_responses(responses(spark, sf_dir))
    return present(EV.reconcile(q, parsed))


@register("response_batch_checks")
def q_response_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = queue_table(spark, sf_dir)
    parsed = EV.parse_responses(responses(spark, sf_dir))
    return present(EV.strict_check(q, parsed))


# ---------------------------------------------------------------------------
# catalogue and lookups
# ---------------------------------------------------------------------------

from ..operators import catalogue as CA  # noqa: E402


def fired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CA.fired_indicators(rule_table(spark, sf_dir))


@register("catalogue_summary")
def q_catalogue_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per typology: catalogued indicators by risk level, transaction types,
    indicators with a rule, and customers / indicators that fired."""
    cat = CA.catalogue(spark)
    rule_ids = spark.createDataFrame([(i,) for _, _, i in R.indicator_ids()], "indicator_id string") \
        .withColumn("has_rule", F.lit(1))
    c = cat.join(F.broadcast(rule_ids), "indicator_id", "left")  # 42 fixed rows
    per = c.groupBy("typology").agg(
        F.count(F.lit(1)).alias("n_indicators"),
        F.count(F.when(F.col("risk_level") == "High", 1)).alias("n_high"),
        F.count(F.when(F.col("risk_level") == "Medium", 1)).alias("n_medium"),
        F.count(F.when(F.col("risk_level") == "Low", 1)).alias("n_low"),
        F.size(F.array_distinct(F.flatten(F.collect_list("transaction_types")))).alias("n_transaction_types"),
        F.count("has_rule").alias("n_with_rule"))
    f = fired(spark, sf_dir).join(F.broadcast(cat.select("indicator_id", "typology")), "indicator_id")
    fc = f.groupBy("typology").agg(F.count_distinct("customer_id").alias("n_customers_fired"),
                                   F.count_distinct("indicator_id").alias("n_indicators_fired"))
    out = per.join(fc, "typology", "left").na.fill(0, ["n_customers_fired", "n_indicators_fired"])
    return present(out)


@register("cooccurrence_edges")
def q_cooc_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue co-occurrence edges with the customers where both ends fired."""
    edges = CA.cooccurrence_edges(CA.catalogue(spark))
    fi = fired(spark, sf_dir)
    a = fi.join(F.broadcast(edges.select("src", "dst")), fi.indicator_id == F.col("src")) \
        .select("customer_id", "src", "dst")
    both = a.join(fi.select("customer_id", F.col("indicator_id").alias("dst")), ["customer_id", "dst"])
    cnt = both.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n_customers_both"))
    out = edges.join(cnt, ["src", "dst"], "left").na.fill(0, ["n_customers_both"])
    return present(out.select("src", "dst", "has_reverse", "dst_in_catalogue", "n_customers_both"))


@register("cooccurrence_observed")
def q_cooc_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indicator pairs that appear together in customers' traces, and
    whether the catalogue lists them as co-occurring."""
    pairs = CA.trace_pairs(rule_table(spark, sf_dir).select(
        "customer_id", TR.trace_array().alias("rule_indicator_trace_items")))
    cnt = pairs.groupBy("ind_a", "ind_b").agg(F.count(F.lit(1)).alias("n_customers"))
    edges = CA.cooccurrence_edges(CA.catalogue(spark))
    und = edges.select(F.least("src", "dst").alias("ind_a"), F.greatest("src", "dst").alias("ind_b")).distinct() \
        .withColumn("catalogued", F.lit(1))
    out = cnt.join(F.broadcast(und), ["ind_a", "ind_b"], "left").na.fill(0, ["catalogued"])
    return present(out)


@register("mcc_indicator_hits")
def q_mcc_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Card transactions whose merchant category is linked to an indicator."""
    t = inputs(spark, sf_dir).txn.where(F.col("channel") == "Card") \
        .select("customer_id", "amount_cad", FE.mcc_code().alias("mcc"))
    m = CA.indicator_mcc(spark)
    j = CA.with_mcc_description(t.join(F.broadcast(m), "mcc"), CA.mcc_intervals(spark))  # fixed map, about 150 rows
    agg = j.groupBy("indicator_id").agg(F.count(F.lit(1)).alias("n_txn"),
                                        F.count_distinct("customer_id").alias("n_customers"),
                                        F.sum("amount_cad").alias("total_amount"),
                                        F.count_distinct("mcc").alias("n_mcc_seen"),
                                        F.array_join(F.array_sort(F.collect_set("description")), "; ").alias("descriptions"))
    return present(agg)


@register("card_mcc_profile")
def q_mcc_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Card transactions per merchant category with its description."""
    t = inputs(spark, sf_dir).txn.where(F.col("channel") == "Card").select(
        "customer_id", "amount_cad", FE.mcc_code().alias("mcc"))
    per = t.groupBy("mcc").agg(F.count(F.lit(1)).alias("n_txn"), F.sum("amount_cad").alias("total_amount"))
    return present(CA.with_mcc_description(per, CA.mcc_intervals(spark)))


@register("rule_catalogue_gap")
def q_rule_catalogue_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every indicator id known to the catalogue or the rule table, whether it
    has each, and how many customers it fired for."""
    cat = CA.catalogue(spark).select("indicator_id").withColumn("in_catalogue", F.lit(1))
    rules = spark.createDataFrame([(i,) for _, _, i in R.indicator_ids()], "indicator_id string") \
        .withColumn("has_rule", F.lit(1))
    ids = cat.join(rules, "indicator_id", "full")
    cnt = fired(spark, sf_dir).groupBy("indicator_id").agg(F.count_distinct("customer_id").alias("n_customers_fired"))
    out = ids.join(cnt, "indicator_id", "left").na.fill(0, ["in_catalogue", "has_rule", "n_customers_fired"])
    return present(out.select("indicator_id", "in_catalogue", "has_rule", "n_customers_fired"))


# ---------------------------------------------------------------------------
# sink round trip and streaming
# ---------------------------------------------------------------------------

from ..sources.channels import read_channel_dir, write_channel_csvs  # noqa: E402


@register("src_sink_roundtrip")
def q_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every channel as a CSV export into the shared folder, read the
    folder back with the explicit schema, unify, and summarise per channel."""
    import uuid

    from ..session import shared_path

    d = shared_path(spark, f"channel-csv-{uuid.uuid4().hex}")
    write_channel_csvs(channel_tables(spark, sf_dir), d)
    t = unify_transactions(read_channel_dir(spark, d))
    return present(t.groupBy("channel").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("customer_id").alias("n_customers"),
        F.sum("amount_cad").alias("total_amount"),
        F.count(F.when(F.col("country").isNull(), 1)).alias("null_country_count"),
        F.min("transaction_datetime").alias("first_transaction_date"),
        F.max("transaction_datetime").alias("last_transaction_date")))


def _landed_by_quarter(spark: SparkSession, sf_dir: str, run) -> str:
    """Land the transactions quarter by quarter, neighbours swapped, and call
    ``run`` after each; then close the stream. The folder of the source."""
    from ..streaming import daily_flow as SD
    from ..streaming import event_windows as EW

    txn = inputs(spark, sf_dir).txn
    source = f"{_scratch(spark, 'stream')}/source"
    for quarter in (2, 1, 4, 3):
        SD.land(txn.where(F.quarter("transaction_datetime") == quarter), source)
        run(source)
    EW.close_stream(spark, source, datetime(2026, 1, 1))
    run(source)
    return source


# A quarter lands before the one it follows: rows are up to 182 days out of order.
LANDED_DELAY = "184 days"


@register("stream_daily_flow")
def q_stream_daily_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily windows with watermark and state over transactions that land out
    of order; equals the batch aggregate per (customer, day)."""
    from ..streaming import event_windows as EW

    def run(source: str) -> None:
        EW.run_daily_windows(spark, source, f"{source}-windows", f"{source}-checkpoint", LANDED_DELAY)
    return present(EW.read_sink(spark, f"{_landed_by_quarter(spark, sf_dir, run)}-windows"))


@register("stream_late_rows")
def q_stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that arrive when the watermark has passed their day: the first
    quarter of every tenth customer lands at the end."""
    from ..streaming import daily_flow as SD
    from ..streaming import event_windows as EW

    txn = inputs(spark, sf_dir).txn
    late = (F.col("customer_id") % 10 == 3) & (F.quarter("transaction_datetime") == 1)
    source = f"{_scratch(spark, 'stream')}/source"

    def run() -> None:
        # one batch takes all files: rows are late for other batches only
        EW.run_daily_windows(spark, source, f"{source}-windows", f"{source}-checkpoint", "7 days", 1_000_000)
    for part in (~F.coalesce(late, F.lit(False)), late):
        SD.land(txn.where(part), source)
        run()
    SD.run_daily_flow(spark, source, f"{source}-arrivals", f"{source}-arrivals-checkpoint")
    EW.close_stream(spark, source, datetime(2026, 1, 1))
    run()
    return present(EW.late_rows(SD.windows(spark, f"{source}-arrivals"), EW.read_sink(spark, f"{source}-windows")))


def reset() -> None:
    """Forget memoised stage outputs (a new run recomputes every stage)."""
    from . import stages
    stages.clear()


@register("high_risk_extracts")
def q_high_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers above 0.60 on the anomaly maximum or the fused score, with
    which extract(s) they fall in."""
    from ..sources.sinks import high_risk_extract

    h = standin_hybrid(spark, sf_dir)
    a = high_risk_extract(h, "if_score_max").select("customer_id", F.lit(1).alias("in_anomaly_extract"))
    b = high_risk_extract(h, "final_hybrid_score").select("customer_id", F.lit(1).alias("in_hybrid_extract"))
    out = a.join(b, "customer_id", "full").na.fill(0, ["in_anomaly_extract", "in_hybrid_extract"])
    return present(out.join(h.select("customer_id", "if_score_max", "final_hybrid_score"), "customer_id"))


@register("request_payloads")
def q_request_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON payloads, one per batch, read as their receiver does."""
    records = EV.request_records(queue_table(spark, sf_dir))
    return present(EV.payload_records(EV.batch_payloads(records), records.schema))


# ---------------------------------------------------------------------------
# the product chain: the same operators over the forest's and KMeans' output
# ---------------------------------------------------------------------------

from ..sources import sinks as SK  # noqa: E402


@register("real_predicted_labels")
def q_real_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(FU.predicted_labels(real_hybrid(spark, sf_dir)))


@register("real_ranked_scores")
def q_real_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = real_hybrid(spark, sf_dir).select("customer_id", "final_hybrid_score", "hybrid_risk_category")
    return present(VA.ranked(h, "final_hybrid_score"))


@register("real_evidence")
def q_real_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(evidence_table(spark, sf_dir, real_hybrid))


@register("real_roc_auc")
def q_real_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(VA.roc_auc(real_hybrid(spark, sf_dir), "actual_label", AUC_SCORES + list(PE.IF_COLS)))


@register("real_capture_at_k")
def q_real_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(VA.capture_at_k(real_hybrid(spark, sf_dir), "actual_label", "final_hybrid_score"))


@register("real_request_records")
def q_real_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(EV.request_records(queue_table(spark, sf_dir, real_hybrid)))


@register("real_narratives")
def q_real_narratives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(narratives_table(spark, sf_dir, real_hybrid))


@register("real_reconciled")
def q_real_reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = EV.parse_responses(responses(spark, sf_dir, real_hybrid))
    return present(EV.reconcile(queue_table(spark, sf_dir, real_hybrid), parsed))


# ---------------------------------------------------------------------------
# sources and sinks as queries
# ---------------------------------------------------------------------------

def _scratch(spark: SparkSession, name: str) -> str:
    import uuid

    from ..session import shared_path

    return shared_path(spark, f"{name}-{uuid.uuid4().hex}")


@register("src_missing_channels")
def q_missing_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exports of two channels only: the others are skipped, not an error."""
    d = _scratch(spark, "some-channels")
    tables = channel_tables(spark, sf_dir)
    write_channel_csvs({c: tables[c] for c in ("Card", "Wire")}, d)
    t = unify_transactions(read_channel_dir(spark, d))
    return present(t.groupBy("channel").agg(F.count(F.lit(1)).alias("n_rows"),
                                            F.sum("amount_cad").alias("total_amount")))


def write_exports(spark: SparkSession, sf_dir: str, directory: str) -> None:
    """The fixture as a folder of CSV exports with records that do not fit:
    in each channel a further record whose amount is no number for every
    seventh customer, and KYC incomes that are no numbers."""
    from ..sources.channels import write_table

    inp = inputs(spark, sf_dir)
    for ch, t in channel_tables(spark, sf_dir).items():
        amount = "amount" if "amount" in t.columns else "amount_cad"
        once = t.where("customer_id % 7 = 0").groupBy("customer_id").agg(*[F.min(c).alias(c) for c in t.columns if c != "customer_id"])
        bad = once.select(*[F.lit("n/a").alias(c) if c == amount else F.col(c).cast("string").alias(c) for c in t.columns])
        lines = t.select(*[F.col(c).cast("string").alias(c) for c in t.columns]).unionByName(bad)
        write_table(lines, f"{directory}/{ch.lower()}.csv", "csv")
    ind = inp.kyc_ind.withColumn("income", F.when(F.col("customer_id") % 50 == 5, F.lit("unknown")).otherwise(F.col("income").cast("string")))
    for name, df in (("kyc_individual", ind), ("kyc_smallbusiness", inp.kyc_bus), ("kyc_occupation_codes", inp.occupation_codes),
                     ("kyc_industry_codes", inp.industry_codes), ("labels", inp.labels)):
        write_table(df, f"{directory}/{name}.csv", "csv")


@register("src_rejected_rows")
def q_rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of a folder of exports by file: read, and set aside because a
    value does not fit its type."""
    d = _scratch(spark, "exports")
    write_exports(spark, sf_dir, d)
    inp, rejects = export_inputs(spark, d, FX.AS_OF)
    good = inp.txn.groupBy(F.col("channel").alias("item")).agg(F.count(F.lit(1)).alias("n_good")).unionByName(
        inp.kyc_ind.agg(F.lit("kyc_individual").alias("item"), F.count(F.lit(1)).alias("n_good")))
    bad = rejects.groupBy(F.col("source").alias("item")).agg(F.count(F.lit(1)).alias("n_rejected"))
    return present(good.join(bad, "item", "left").na.fill(0, ["n_rejected"]))


@register("src_export_features")
def q_export_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer features from a folder of CSV exports."""
    d = _scratch(spark, "exports")
    write_exports(spark, sf_dir, d)
    inp, _ = export_inputs(spark, d, FX.AS_OF)
    return present(P.customer_base(inp).select("customer_id", "transaction_count_total", "total_volume", "card_luxury_sum",
                                               "occupation_risk_high", "sales", "age", "customer_tenure_days"))


@register("sink_results")
def q_sink_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full and the high-risk score table, written and read back."""
    d = _scratch(spark, "results")
    h = standin_hybrid(spark, sf_dir).select("customer_id", "final_hybrid_score")
    SK.write_results(h, d, "final_hybrid_score")
    parts = [spark.read.parquet(f"{d}/{kind}").withColumn("kind", F.lit(kind)) for kind in ("all", "high_risk")]
    return present(parts[0].unionByName(parts[1]))


@register("sink_feature_table")
def q_sink_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table, written after the expected-column check and read back."""
    from ..sources.channels import write_table

    f = features(spark, sf_dir)
    if missing := VA.missing_columns(f, ["customer_id", *P.FEATURE_COLUMNS]):
        raise ValueError(f"the feature table lacks {missing}")
    d = _scratch(spark, "features")
    write_table(f, d)
    back = spark.read.parquet(d)
    return present(back.select("customer_id", "total_volume", "overall_typology_max_risk"))


@register("sink_explanations")
def q_sink_explanations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reconciled explanations in finished batches: the even batches are done
    first, a second run writes what is pending, and the CSV holds all."""
    done, out = _scratch(spark, "batches"), _scratch(spark, "explanations")
    rows = EV.reconcile(queue_table(spark, sf_dir), EV.parse_responses(responses(spark, sf_dir)))
    rows = P.materialize(rows.select("batch_id", "customer_id", "explanation"))
    SK.write_batch_rows(rows.where("batch_id % 2 = 1"), done)  # a run that ended before its ledger entry
    SK.append_batch_results(rows.where("batch_id % 2 = 0"), done)
    SK.append_batch_results(SK.pending_batches(spark, rows, done), done)
    SK.write_explanations(SK.finished_batches(spark, done), out)
    back = spark.read.option("header", True).option("escape", '"').csv(out)
    return present(back.select("customer_id", "explanation"))


@register("model_round_trip")
def q_model_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forest and clusters as one saved and loaded ``PipelineModel`` that
    scores all customers again: the largest difference from the first scores,
    and the customers in another cluster."""
    from pyspark.ml import PipelineModel

    from ..operators import models as MO

    f = features(spark, sf_dir)
    kmeans, _, _ = real_model(spark, sf_dir)
    scores, nodes, sets, logged = memo(spark, sf_dir, "fit_and_score", lambda: AN.fit_and_score(f))
    matrix = MO.FeatureMatrixModel().knowing(sets=sets, logged=sorted(logged))
    n = f.count()
    forest = MO.forest_model(nodes, sets, min(K.FOREST_SAMPLE, n))
    forest.knowing(**{**forest.known(), "ranges": AN.score_ranges(forest.raw_scores(matrix.transform(f)))})
    vectors = MO.PeerVectors().fit(real_anomaly(spark, sf_dir))
    path = f"{_scratch(spark, 'models')}/pipeline"
    PipelineModel(stages=[matrix, forest, vectors, kmeans]).write().overwrite().save(path)
    again = PipelineModel.load(path).transform(f)
    was = scores.join(real_peers(spark, sf_dir).select("customer_id", "cluster"), "customer_id")
    gap = F.greatest(*[F.abs(F.col(f"a.{c}") - F.col(f"b.{c}")) for c in PE.IF_COLS])
    return present(was.alias("a").join(again.alias("b"), "customer_id").agg(
        F.count(F.lit(1)).alias("n_customers"), F.max(gap).alias("largest_gap"),
        F.count(F.when(F.col("a.cluster") != F.col("b.prediction"), 1)).alias("n_moved")))


@register("catalogue_csv")
def q_catalogue_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue read from its CSV export, with the customers that each
    indicator fired for."""
    d = _scratch(spark, "catalogue")
    CA.write_catalogue_csv(spark, d)
    cat = CA.read_catalogue_csv(spark, d)
    n = fired(spark, sf_dir).groupBy("indicator_id").agg(F.count_distinct("customer_id").alias("n_customers"))
    return present(cat.join(n, "indicator_id", "left").select(
        "indicator_id", "risk_level", F.size("transaction_type").alias("n_types"),
        F.size("co_occurring_indicators").alias("n_co_occurring"),
        F.coalesce("n_customers", F.lit(0)).alias("n_customers")))


# ---------------------------------------------------------------------------
# further analyses
# ---------------------------------------------------------------------------

from ..operators import extras as EX  # noqa: E402

for _name in ("hour_entropy", "card_retail_avg", "geo_volume_z", "hotel_cash_match", "same_day_turnover"):
    REGISTRY[_name] = lambda spark, sf_dir, f=getattr(EX, _name): present(f(inputs(spark, sf_dir).txn))


@register("stream_structuring_alerts")
def q_stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bursts of two or more amounts just under the reporting threshold within
    24 hours, as the stream raises them."""
    from ..streaming import daily_flow as SD
    from ..streaming import event_windows as EW

    def run(source: str) -> None:
        EW.run_alerts(spark, source, f"{source}-alerts", f"{source}-checkpoint", LANDED_DELAY, least=2)
    source = _landed_by_quarter(spark, sf_dir, run)
    alerts = EW.read_sink(spark, f"{source}-alerts")
    return present(alerts.select("customer_id", SD.utc_wall(F.col("first_time")).alias("first_time")))
