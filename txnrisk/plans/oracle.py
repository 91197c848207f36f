"""DuckDB oracle SQL per registered query (same column names, same
presentation). Queries without an entry get the driver's rows-only check."""

from __future__ import annotations

from .. import constants as K
from ..operators import composites as C
from ..operators import features as FE
from . import oracle_features as OF
from .present import sql_select

ORACLE: dict[str, str] = {}

TXN = OF.ctes(OF.TXN_CTES)
BEH = OF.ctes(OF.TXN_CTES, OF.KYC_CTES, OF.WIDE_CTE, OF.BEH_CTE)
KYCF = OF.ctes(OF.TXN_CTES, OF.KYC_CTES, OF.WIDE_CTE, OF.BEH_CTE, OF.KYCF_CTE)
SEG = OF.ctes(OF.TXN_CTES, OF.KYC_CTES, OF.WIDE_CTE, OF.BEH_CTE, OF.KYCF_CTE, OF.SEG_CTE)
COMP = OF.ctes(OF.TXN_CTES, OF.KYC_CTES, OF.WIDE_CTE, OF.BEH_CTE, OF.KYCF_CTE, OF.SEG_CTE, OF.COMP_CTE)
FT = OF.ctes(*OF.FEATURE_CTES)


def _block(cols: list[str]) -> str:
    return BEH + "\n" + sql_select(["customer_id", *cols], "beh")


ORACLE["unify_transactions"] = TXN + "\n" + sql_select(
    ["customer_id", "amount_cad", "debit_credit", "transaction_datetime", "country", "province", "city",
     "merchant_category", "ecommerce_ind", "cash_indicator", "channel", "hour", "day_of_week",
     "year_month", "date"], "txn")

ORACLE["src_channel_scan"] = TXN + """,
agg AS (
  SELECT channel, count(*) AS n_rows, count(DISTINCT customer_id) AS n_customers,
    sum(amount_cad) AS total_amount, count(*) FILTER (WHERE country IS NULL) AS null_country_count,
    min(transaction_datetime) AS first_transaction_date, max(transaction_datetime) AS last_transaction_date
  FROM txn GROUP BY channel
)
""" + sql_select(["channel", "n_rows", "n_customers", "total_amount", "null_country_count",
                  "first_transaction_date", "last_transaction_date"], "agg")

ORACLE["volume_features"] = _block([
    "transaction_count_total", "total_volume", "avg_transaction_amount", "median_transaction_amount",
    "std_transaction_amount", "min_transaction_amount", "max_transaction_amount",
    "first_transaction_date", "last_transaction_date", "active_days"])
ORACLE["flow_features"] = _block([
    "transaction_count_debit", "total_outflow", "transaction_count_credit", "total_inflow", "net_flow",
    "inflow_outflow_ratio", "amount_cv", "time_span_days", "transactions_per_day",
    "transactions_per_active_day", "volume_per_day", "inflow_per_day", "outflow_per_day",
    "flow_through_ratio"])
ORACLE["gap_features"] = _block(["max_days_between_txns", "time_span_days", "active_days"])
ORACLE["structuring_features"] = _block(FE.STRUCTURING_COLUMNS)
ORACLE["channel_features"] = _block([c for c in FE.CHANNEL_COLUMNS if c != "channel_concentration_hhi"])
ORACLE["channel_hhi"] = _block(["channel_concentration_hhi", "unique_channels"])
ORACLE["card_mcc_features"] = _block([c for c in FE.CARD_COLUMNS if "30d" not in c and "90d" not in c])
ORACLE["card_recency_features"] = _block(["card_volume_30d", "card_volume_90d", "card_30d_ratio",
                                          "card_90d_ratio"])
ORACLE["eft_emt_features"] = _block(FE.EFT_EMT_COLUMNS)
ORACLE["geo_features"] = _block(FE.GEO_COLUMNS)
ORACLE["temporal_features"] = _block(FE.TEMPORAL_COLUMNS[:7])
ORACLE["monthly_features"] = _block(FE.TEMPORAL_COLUMNS[7:])

ORACLE["kyc_risk_tiers"] = OF.ctes(OF.KYC_CTES) + """,
tiers AS (
  SELECT customer_id, 'individual' AS kind, occupation_code AS code, occupation_risk_high AS risk_high,
         0 AS ht_accommodation_sector FROM kyc_ind_t
  UNION ALL
  SELECT customer_id, 'business', industry_code, industry_risk_high, ht_accommodation_sector FROM kyc_bus_t
)
""" + sql_select(["customer_id", "kind", "code", "risk_high", "ht_accommodation_sector"], "tiers",
                 {"kind": "s", "code": "i", "risk_high": "i"})

_KYC_COLS = ["income", "occupation_code", "birth_date", "onboard_date", "occupation_risk_high",
             "sales", "industry_code", "employee_count", "established_date", "industry_risk_high",
             "ht_accommodation_sector", "customer_type", "is_business", "is_individual", "age",
             "customer_tenure_days"]
ORACLE["kyc_features"] = KYCF + "\n" + sql_select(["customer_id", *_KYC_COLS], "kf")

ORACLE["segment_ratios"] = SEG + "\n" + sql_select(
    ["customer_id", *C.SEGMENT_COLUMNS, "spending_to_income_ratio", "volume_to_sales_ratio",
     "income_vol_ratio"], "zf")

ORACLE["population_p99"] = SEG + ",\np99long AS (\n" + "\n  UNION ALL ".join(
    f"SELECT '{c}' AS feature, {c} AS p99 FROM p99" for c in OF.P99_COLS) + "\n)\n" + \
    sql_select(["feature", "p99"], "p99long", {"feature": "s", "p99": "d"})

ORACLE["impute_features"] = COMP + ",\nimp AS (\n" + "\n  UNION ALL ".join(
    f"SELECT '{c}' AS feature, quantile_cont({c}, 0.5) AS median, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM cp"
    for c in OF.IMPUTE_COLS) + "\n)\n" + sql_select(["feature", "median", "null_count"], "imp",
                                                    {"feature": "s", "median": "d", "null_count": "i"})

ORACLE["composite_scores"] = FT + "\n" + sql_select(["customer_id", *C.COMPOSITE_COLUMNS], "ft")


def feature_table_columns() -> list[str]:
    from .pipeline import FEATURE_COLUMNS
    return ["customer_id", *FEATURE_COLUMNS, "label"]


ORACLE["feature_table"] = FT + "\n" + sql_select(feature_table_columns(), "ft")

ORACLE["data_quality"] = SEG + """,
dq AS (
  SELECT 'rows' AS metric, channel AS item, CAST(count(*) AS DOUBLE) AS value FROM txn GROUP BY channel
  UNION ALL
  SELECT 'customers', 'all', CAST(count(DISTINCT customer_id) AS DOUBLE) FROM txn
  UNION ALL
  SELECT * FROM (SELECT 'top_mcc', mcc, CAST(count(*) AS DOUBLE) AS c FROM txn WHERE channel = 'Card'
                 GROUP BY mcc ORDER BY c DESC, mcc LIMIT 20)
""" + "".join(
    f"  UNION ALL\n  SELECT 'null_inputs', '{c}', CAST(count(*) FILTER (WHERE {c}{raw} IS NULL) AS DOUBLE) FROM sr\n"
    for raw, names in (("_raw", ["spending_to_income_ratio", "volume_to_sales_ratio", "income_vol_ratio"]),
                       ("", ["monthly_volume_cv", "amount_cv", "flow_through_ratio", "ratio_round_100",
                             "transactions_per_active_day"])) for c in names) + """)
""" + sql_select(["metric", "item", "value"], "dq", {"value": "d"})

ORACLE["src_missing_channels"] = TXN + """,
two AS (SELECT channel, count(*) AS n_rows, sum(amount_cad) AS total_amount FROM txn
         WHERE channel IN ('Card', 'Wire') GROUP BY channel)
""" + sql_select(["channel", "n_rows", "total_amount"], "two", {"total_amount": "d"})

ORACLE["sink_feature_table"] = FT + "\n" + sql_select(
    ["customer_id", "total_volume", "overall_typology_max_risk"], "ft")


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


# ---------------------------------------------------------------------------
# rules and trace
# ---------------------------------------------------------------------------

from ..operators import rules as R  # noqa: E402
from .oracle_features import d  # noqa: E402


def _ind_alias(ind: str) -> str:
    return ind.lower().replace("-", "_")


def _rule_inputs_cte() -> str:
    names = R.referenced_features()
    cols = ", ".join(f"coalesce(CAST({n} AS DOUBLE), 0.0) AS {n}" for n in names)
    derived = ", ".join(f"CAST({e} AS DOUBLE) AS {n}" for n, e in R.DERIVED_INPUTS.items())
    return f"""
ri0 AS (SELECT customer_id, {cols} FROM ft),
ri AS (SELECT *, {derived} FROM ri0)"""


def _clip01(x: str) -> str:
    return f"(CASE WHEN ({x}) < 0 THEN 0.0 WHEN ({x}) > 1 THEN 1.0 ELSE ({x}) END)"


def _points_cte() -> str:
    cols = []
    for typ in K.TYPOLOGIES:
        for ind, ladders in R.RULES[typ]:
            cols.append(f'{R.indicator_sql(ladders)} AS "{_ind_alias(ind)}"')
    rp = f"rp0 AS (SELECT customer_id, {', '.join(cols)} FROM ri)"
    scores = []
    for typ in K.TYPOLOGIES:
        s = " + ".join(f'"{_ind_alias(i)}"' for i, _ in R.RULES[typ])
        scores.append(f"{_clip01(s)} AS rule_{typ}")
    rp1 = f"rp AS (SELECT *, {', '.join(scores)} FROM rp0)"
    weighted = " + ".join(f"rule_{t} * {d(K.TYPOLOGY_WEIGHTS[t])}" for t in K.TYPOLOGIES)
    trig = " + ".join(f"CASE WHEN rule_{t} > 0 THEN 1 ELSE 0 END" for t in K.TYPOLOGIES)
    best = "greatest(" + ", ".join(f"rule_{t}" for t in K.TYPOLOGIES) + ")"
    argmax = "CASE " + " ".join(f"WHEN rule_{t} = {best} THEN '{K.TYPOLOGY_LABELS[t]}'"
                                for t in K.TYPOLOGIES) + " END"
    rs = (f"rs AS (SELECT *, {weighted} AS rule_score_weighted, {trig} AS rules_triggered, "
          f"{argmax} AS primary_rule_typology FROM rp)")
    return ",\n".join([rp, rp1, rs])


def _trace_cte(weight_expr=None, src: str = "rs", name: str = "tr") -> str:
    """Relational trace: unpivot -> filter -> rank -> group in first-seen order."""
    branches = []
    for ordinal, typ, ind in R.indicator_ids():
        w = weight_expr(typ) if weight_expr else d(K.TYPOLOGY_WEIGHTS[typ])
        branches.append(
            f"SELECT customer_id, {ordinal} AS ord, '{K.TYPOLOGY_PREFIX[typ]}' AS typ, '{ind}' AS ind, "
            f'"{_ind_alias(ind)}" AS points, "{_ind_alias(ind)}" * {w} AS impact FROM {src}')
    union = "\n    UNION ALL ".join(branches)
    return f"""
{name}_long AS (
    {union}
),
{name}_rk AS (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY impact DESC, ord) AS rn
  FROM {name}_long WHERE points > 0 AND impact >= {d(K.TRACE_MIN_IMPACT)}
),
{name}_top AS (
  SELECT *, min(rn) OVER (PARTITION BY customer_id, typ) AS g,
    ind || '(' || CASE WHEN points > {d(K.TRACE_SEVERITY_HIGH)} THEN 'H'
                       WHEN points >= {d(K.TRACE_SEVERITY_MEDIUM)} THEN 'M' ELSE 'L' END || ')' AS item
  FROM {name}_rk WHERE rn <= {K.TRACE_TOP_N}
),
{name}_grp AS (
  SELECT customer_id, g, typ, string_agg(item, ', ' ORDER BY rn) AS items FROM {name}_top GROUP BY customer_id, g, typ
),
{name} AS (
  SELECT s.customer_id, coalesce(x.t, '') AS rule_indicator_trace
  FROM {src} s LEFT JOIN (
    SELECT customer_id, string_agg(typ || ': ' || items, ' | ' ORDER BY g) AS t FROM {name}_grp GROUP BY customer_id
  ) x ON s.customer_id = x.customer_id
)"""


RULES_SQL = FT + "," + _rule_inputs_cte() + ",\n" + _points_cte()
TRACE_SQL = RULES_SQL + "," + _trace_cte()

for _typ in K.TYPOLOGIES:
    ORACLE[f"rules_{_typ}"] = RULES_SQL + "\n" + sql_select(
        ["customer_id", *[_ind_alias(i) for i, _ in R.RULES[_typ]], f"rule_{_typ}"], "rs",
        {_ind_alias(i): "d" for i, _ in R.RULES[_typ]})

ORACLE["rule_scores"] = RULES_SQL + "\n" + sql_select(
    ["customer_id", *[f"rule_{t}" for t in K.TYPOLOGIES], "rule_score_weighted", "rules_triggered",
     "primary_rule_typology"], "rs")

ORACLE["indicator_trace"] = TRACE_SQL + "\n" + sql_select(["customer_id", "rule_indicator_trace"], "tr")


def _trace_counts_cte(src: str = "tr") -> str:
    cnt = []
    for typ in K.TYPOLOGIES:
        aliases = [a for a, t in K.TRACE_PREFIX_ALIASES.items() if t == typ]
        lst = ", ".join(f"'{a}'" for a in aliases)
        cnt.append(f"count(it) FILTER (WHERE p IN ({lst}) AND trim(it) <> '') AS n_{typ}")
    return f"""
tc_seg AS (
  SELECT customer_id, unnest(string_split(rule_indicator_trace, '|')) AS seg FROM {src}
),
tc_seg2 AS (
  SELECT customer_id, lower(trim(split_part(seg, ':', 1))) AS p,
    CASE WHEN strpos(seg, ':') > 0 THEN substr(seg, strpos(seg, ':') + 1) END AS rest
  FROM tc_seg
),
tc_it AS (
  SELECT customer_id, p, unnest(string_split(rest, ',')) AS it FROM tc_seg2 WHERE rest IS NOT NULL
),
tc AS (
  SELECT s.customer_id, {", ".join(f"coalesce(x.n_{t}, 0) AS n_{t}" for t in K.TYPOLOGIES)}
  FROM {src} s LEFT JOIN (SELECT customer_id, {", ".join(cnt)} FROM tc_it GROUP BY customer_id) x
    ON s.customer_id = x.customer_id
)"""


ORACLE["trace_counts"] = TRACE_SQL + "," + _trace_counts_cte() + "\n" + sql_select(
    ["customer_id", *[f"n_{t}" for t in K.TYPOLOGIES]], "tc")


# ---------------------------------------------------------------------------
# anomaly, peers, fusion, validation
# ---------------------------------------------------------------------------

from .. import constants as _K  # noqa: E402
from ..operators.anomaly import resolve_feature_cols  # noqa: E402

_NON_NUMERIC = {"customer_type", "established_date", "first_transaction_date", "last_transaction_date",
                "birth_date", "onboard_date"}


def _available() -> list[str]:
    return [c for c in feature_table_columns()
            if c not in _K.EXCLUDE_MODEL_COLS and c not in _NON_NUMERIC]


SETS = {t: resolve_feature_cols(_K.TYPOLOGY_FEATURE_PATTERNS[t], _available()) for t in _K.TYPOLOGIES}
_ALL_SET_COLS = sorted({c for v in SETS.values() for c in v})
_LOG_CAND = [c for c in _ALL_SET_COLS if any(p in c for p in _K.LOG_TRANSFORM_PATTERNS)]


def _sq(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_FS_VALUES = ", ".join(f"({_sq(t)}, {i}, {_sq(c)})" for t in _K.TYPOLOGIES for i, c in enumerate(SETS[t]))

ANOM_CTES = f""",
mins AS (SELECT {", ".join(f"min(CAST({c} AS DOUBLE)) AS {c}" for c in _LOG_CAND)} FROM ft),
fs(typology, position, feature) AS (VALUES {_FS_VALUES}),
fstats AS (
  {" UNION ALL ".join(f"SELECT {_sq(c)} AS feature, count({c}) AS n_nonnull, min(CAST({c} AS DOUBLE)) AS min_value, max(CAST({c} AS DOUBLE)) AS max_value FROM ft" for c in _ALL_SET_COLS)}
),
prep AS (
  {" UNION ALL ".join(
    "SELECT ft.customer_id, " + _sq(t) + " AS typology, " + _sq(c) + " AS feature, "
    + "(CASE WHEN v IS NULL OR isnan(v) OR isinf(v) THEN 0.0 ELSE v END) AS value FROM (SELECT ft.customer_id, "
    + (f"CASE WHEN mins.{c} >= 0 THEN ln(1 + CAST(ft.{c} AS DOUBLE)) ELSE CAST(ft.{c} AS DOUBLE) END"
       if c in _LOG_CAND else f"CAST(ft.{c} AS DOUBLE)")
    + " AS v FROM ft CROSS JOIN mins) ft"
    for t in _K.TYPOLOGIES for c in SETS[t])}
),
rparams AS (
  SELECT typology, feature, quantile_cont(value, 0.5) AS med,
    quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS iqr
  FROM prep GROUP BY typology, feature
),
scaled AS (
  SELECT p.customer_id, p.typology, p.feature,
    (p.value - r.med) / CASE WHEN r.iqr = 0 THEN 1.0 ELSE r.iqr END AS value
  FROM prep p JOIN rparams r ON p.typology = r.typology AND p.feature = r.feature
)"""

_is_log = " OR ".join(f"contains(fs.feature, {_sq(p)})" for p in _K.LOG_TRANSFORM_PATTERNS)

ORACLE["feature_sets"] = FT + ANOM_CTES + f""",
fsout AS (
  SELECT fs.typology, fs.position, fs.feature,
    CASE WHEN ({_is_log}) AND st.min_value >= 0 THEN 1 ELSE 0 END AS is_log,
    st.n_nonnull, st.min_value, st.max_value
  FROM fs JOIN fstats st ON fs.feature = st.feature
)
""" + sql_select(["typology", "position", "feature", "is_log", "n_nonnull", "min_value", "max_value"], "fsout",
                 {"position": "i", "is_log": "i", "min_value": "d", "max_value": "d"})

ORACLE["log_transform"] = FT + ANOM_CTES + "\n" + sql_select(
    ["customer_id", "typology", "feature", "value"], "prep", {"value": "d"})
ORACLE["robust_scale"] = FT + ANOM_CTES + "\n" + sql_select(
    ["customer_id", "typology", "feature", "value"], "scaled", {"value": "d"})

_IFC = [f"if_score_{t}" for t in _K.TYPOLOGIES]
_GREATEST_IF = "greatest(" + ", ".join(_IFC) + ")"


def _argmax(cols: list[str], labels: list[str]) -> str:
    g = "greatest(" + ", ".join(cols) + ")"
    return "CASE " + " ".join(f"WHEN {c} = {g} THEN {_sq(lab)}" for c, lab in zip(cols, labels)) + " END"


def _band(x: str) -> str:
    return ("CASE " + " ".join(f"WHEN {x} >= {lo} THEN {_sq(lab)}" for lo, lab in _K.RISK_BANDS)
            + f" ELSE {_sq(_K.RISK_BAND_FLOOR)} END")


_MEAN_IF = "(" + " + ".join(_IFC) + f") / {d(5.0)}"
_W_IF = " + ".join(f"if_score_{t} * {d(_K.TYPOLOGY_WEIGHTS[t])}" for t in _K.TYPOLOGIES)

HY_CTES = f""",
an0 AS (
  SELECT customer_id, label AS actual_label, {", ".join(f"{t}_risk AS if_score_{t}" for t in _K.TYPOLOGIES)}
  FROM ft
),
an AS (
  SELECT *, {_GREATEST_IF} AS if_score_max, {_MEAN_IF} AS if_score_mean,
    {_argmax(_IFC, [_K.TYPOLOGY_LONG_LABELS[t] for t in _K.TYPOLOGIES])} AS primary_typology,
    {_band(_GREATEST_IF)} AS risk_category,
    {_W_IF} AS if_score_weighted
  FROM an0
),
cl AS (SELECT *, least(CAST(floor(if_score_mean * 10) AS INTEGER), 9) AS cluster FROM an),
prof0 AS (
  SELECT cluster, count(*) AS n_customers, {", ".join(f"avg({c}) AS {c}" for c in _IFC)},
    avg(if_score_mean) AS cluster_if_mean
  FROM cl GROUP BY cluster
),
prof AS (
  SELECT prof0.*,
    CASE WHEN {_GREATEST_IF} < {d(_K.CLUSTER_LOW_RISK_CUTOFF)} THEN {_sq(_K.GENERAL_LOW_RISK_LABEL)}
         ELSE {_argmax(_IFC, [_K.TYPOLOGY_LABELS[t] for t in _K.TYPOLOGIES])} END AS cluster_primary_typology,
    {d(0.1)} + {d(0.9)} * (cluster_if_mean - mm.tmin) / (mm.tmax - mm.tmin + {d(1e-9)}) AS cluster_risk_tier
  FROM prof0 CROSS JOIN (SELECT min(cluster_if_mean) AS tmin, max(cluster_if_mean) AS tmax FROM prof0) mm
),
pct AS (
  SELECT customer_id, cluster,
    row_number() OVER (PARTITION BY cluster ORDER BY if_score_mean, customer_id) AS rank,
    count(*) OVER (PARTITION BY cluster) AS cluster_size
  FROM cl
),
pct2 AS (
  SELECT *, (rank - 1) / CAST(greatest(cluster_size - 1, 1) AS DOUBLE) AS kmeans_score FROM pct
),
hy0 AS (
  SELECT an.*, {", ".join(f"rs.rule_{t}" for t in _K.TYPOLOGIES)}, rs.rule_score_weighted, rs.rules_triggered,
    {", ".join(f"an.if_score_{t} * rs.rule_{t} AS dynamic_{t}" for t in _K.TYPOLOGIES)},
    pct2.cluster, prof.cluster_risk_tier, prof.cluster_primary_typology, pct2.kmeans_score
  FROM an JOIN rs ON an.customer_id = rs.customer_id
  JOIN pct2 ON an.customer_id = pct2.customer_id
  JOIN prof ON pct2.cluster = prof.cluster
),
hy1 AS (
  SELECT *, {" + ".join(f"dynamic_{t}" for t in _K.TYPOLOGIES)} AS dynamic_score_raw FROM hy0
),
hy2 AS (
  SELECT hy1.*,
    (dynamic_score_raw - dm.dmin) / (dm.dmax - dm.dmin + {d(1e-9)}) AS dynamic_score_norm,
    {_argmax([f"dynamic_{t}" for t in _K.TYPOLOGIES], [_K.TYPOLOGY_LABELS[t] for t in _K.TYPOLOGIES])}
      AS primary_rule_typology,
    ({" + ".join(f"CAST(CASE WHEN rule_{t} > 0 THEN 1 ELSE 0 END AS DOUBLE)" for t in _K.TYPOLOGIES)}) / {d(5.0)}
      AS coverage,
    kmeans_score * cluster_risk_tier AS adjusted_kmeans_score
  FROM hy1 CROSS JOIN (SELECT min(dynamic_score_raw) AS dmin, max(dynamic_score_raw) AS dmax FROM hy1) dm
),
hy3 AS (
  SELECT *, {d(_K.PILLAR_DYNAMIC)} * dynamic_score_norm
            + {d(_K.PILLAR_FALLBACK)} * ({d(1.0)} - coverage) * if_score_weighted
            + {d(_K.PILLAR_PEER)} * adjusted_kmeans_score AS final_raw
  FROM hy2
),
hy AS (
  SELECT hy3.* EXCLUDE (final_raw),
    (final_raw - fm.fmin) / nullif(fm.fmax - fm.fmin, 0) AS final_hybrid_score,
    {_band("((final_raw - fm.fmin) / nullif(fm.fmax - fm.fmin, 0))")} AS hybrid_risk_category
  FROM hy3 CROSS JOIN (SELECT min(final_raw) AS fmin, max(final_raw) AS fmax FROM hy3) fm
)"""

HY = TRACE_SQL + HY_CTES

ORACLE["score_rollup"] = FT + HY_CTES.split(",\ncl AS")[0].replace(",\nan0", ",\nan0", 1) + "\n" + sql_select(
    ["customer_id", "if_score_max", "if_score_mean", "primary_typology", "risk_category"], "an")

ORACLE["peer_profile"] = HY + "\n" + sql_select(
    ["cluster", "n_customers", *_IFC, "cluster_if_mean", "cluster_primary_typology", "cluster_risk_tier"], "prof",
    {"n_customers": "i"})
ORACLE["peer_percentile"] = HY + "\n" + sql_select(
    ["customer_id", "cluster", "rank", "cluster_size", "kmeans_score"], "pct2", {"cluster_size": "i"})

from ..operators.fusion import EVIDENCE_COLUMNS, HYBRID_COLUMNS  # noqa: E402

ORACLE["fusion"] = HY + "\n" + sql_select(HYBRID_COLUMNS, "hy")

ORACLE["predicted_labels"] = HY + """,
pl AS (
  SELECT customer_id,
    CASE WHEN final_hybrid_score >= (SELECT quantile_cont(final_hybrid_score, 0.99) FROM hy) THEN 1 ELSE 0 END
      AS predicted_label,
    final_hybrid_score AS risk_score
  FROM hy
)
""" + sql_select(["customer_id", "predicted_label", "risk_score"], "pl", {"risk_score": "d"})

_RANK = "row_number() OVER (ORDER BY final_hybrid_score DESC NULLS LAST, customer_id)"
ORACLE["ranked_scores"] = HY + f""",
rk AS (SELECT customer_id, {_RANK} AS rank, final_hybrid_score, hybrid_risk_category FROM hy)
""" + sql_select(["customer_id", "rank", "final_hybrid_score", "hybrid_risk_category"], "rk")

_DYN_SRC = "rsd"
ORACLE["indicator_trace_dynamic"] = HY + f""",
rsd AS (SELECT rs.*, {", ".join(f"an.if_score_{t}" for t in _K.TYPOLOGIES)} FROM rs JOIN an
        ON rs.customer_id = an.customer_id),""" + _trace_cte(
    lambda t: f"coalesce(if_score_{t}, 0.0)", src=_DYN_SRC, name="trd").lstrip(",") + "\n" + sql_select(
    ["customer_id", "rule_indicator_trace"], "trd")

ORACLE["evidence"] = HY + """,
ev AS (SELECT hy.*, tr.rule_indicator_trace FROM hy LEFT JOIN tr ON hy.customer_id = tr.customer_id
       WHERE hy.final_hybrid_score > 0.5)
""" + sql_select(EVIDENCE_COLUMNS, "ev")

_AUC_SCORES = ["final_hybrid_score", "if_score_weighted", "if_score_max", "rule_score_weighted",
               "dynamic_score_norm", "adjusted_kmeans_score"] + _IFC
ORACLE["roc_auc"] = HY + f""",
lab AS (
  {" UNION ALL ".join(f"SELECT {_sq(s)} AS score, CAST(actual_label AS INTEGER) AS y, CAST({s} AS DOUBLE) AS v FROM hy WHERE actual_label IS NOT NULL" for s in _AUC_SCORES)}
),
lr AS (
  SELECT *, rank() OVER (PARTITION BY score ORDER BY v) + (count(*) OVER (PARTITION BY score, v) - 1) / 2.0 AS mr
  FROM lab
),
au AS (
  SELECT score, count(*) FILTER (WHERE y = 1) AS n_pos, count(*) FILTER (WHERE y = 0) AS n_neg,
    sum(mr) FILTER (WHERE y = 1) AS rsum
  FROM lr GROUP BY score
),
au2 AS (
  SELECT score, CASE WHEN n_pos > 0 AND n_neg > 0
                     THEN (rsum - n_pos * (n_pos + 1) / 2.0) / (n_pos * CAST(n_neg AS DOUBLE)) ELSE 0.0 END AS auc,
    n_pos, n_neg FROM au
),
ord(score, ord) AS (VALUES {", ".join(f"({_sq(s)}, {i})" for i, s in enumerate(_IFC))}),
best AS (SELECT au2.score FROM au2 JOIN ord ON au2.score = ord.score ORDER BY round(auc, 10) DESC, ord LIMIT 1),
aout AS (SELECT au2.*, CASE WHEN au2.score = (SELECT score FROM best) THEN 1 ELSE 0 END AS is_best FROM au2)
""" + sql_select(["score", "auc", "n_pos", "n_neg", "is_best"], "aout", {"auc": "d"})

ORACLE["capture_at_k"] = HY + f""",
rk AS (SELECT customer_id, actual_label, {_RANK} AS rank FROM hy),
pcts(pct) AS (VALUES (CAST(0.01 AS DOUBLE)), (CAST(0.05 AS DOUBLE)), (CAST(0.1 AS DOUBLE))),
cuts AS (SELECT pct, CAST(floor((SELECT count(*) FROM hy) * pct) AS BIGINT) AS cutoff FROM pcts),
cap AS (
  SELECT pct, cutoff,
    (SELECT count(*) FROM rk WHERE actual_label = 1 AND rank <= cutoff) AS captured,
    (SELECT count(*) FROM rk WHERE actual_label = 1) AS positives
  FROM cuts
)
""" + sql_select(["pct", "cutoff", "captured", "positives"], "cap", {"pct": "d", "cutoff": "i", "captured": "i"})

ORACLE["positive_breakdown"] = HY + f""",
rk AS (SELECT *, {_RANK} AS rank FROM hy)
""" + sql_select(["customer_id", "final_hybrid_score", "if_score_weighted", "dynamic_score_norm", "coverage",
                  "rule_score_weighted", "kmeans_score", "cluster_risk_tier", "cluster_primary_typology", "rank"],
                 "rk", where="actual_label = 1")

from .queries import GROUNDING_FEATURES  # noqa: E402

_g_parts = []
for _t in _K.TYPOLOGIES:
    for _f in GROUNDING_FEATURES[_t]:
        _g_parts.append(
            f"SELECT {_sq(_t)} AS typology, {_sq(_f)} AS feature, "
            f"(SELECT avg(CAST({_f} AS DOUBLE)) FROM (SELECT ft.{_f} FROM ft JOIN an ON ft.customer_id = an.customer_id "
            f"ORDER BY an.if_score_{_t} DESC NULLS LAST, ft.customer_id LIMIT 50)) AS top_mean, "
            f"(SELECT avg(CAST({_f} AS DOUBLE)) FROM ft) AS population_mean")
ORACLE["grounding_lift"] = HY + ",\ngl0 AS (\n  " + "\n  UNION ALL ".join(_g_parts) + """
),
gl AS (
  SELECT *, top_mean / (population_mean + 1e-9) AS ratio FROM gl0
),
gl2 AS (
  SELECT *, CASE WHEN ratio > 3 THEN '✓' WHEN ratio > 1.5 THEN '?' ELSE '✗' END AS flag FROM gl
)
""" + sql_select(["typology", "feature", "top_mean", "population_mean", "ratio", "flag"], "gl2",
                 {"top_mean": "d", "population_mean": "d", "ratio": "d", "flag": "s"})

_top_parts = " UNION ALL ".join(
    f"SELECT customer_id, {_sq(t)} AS typology FROM (SELECT customer_id FROM an ORDER BY if_score_{t} DESC NULLS LAST, "
    f"customer_id LIMIT (SELECT CAST(floor(count(*) * 0.01) AS BIGINT) FROM an))" for t in _K.TYPOLOGIES)
_pairs = ", ".join(f"({_sq(a)}, {_sq(b)})" for i, a in enumerate(sorted(_K.TYPOLOGIES))
                   for b in sorted(_K.TYPOLOGIES)[i + 1:])
ORACLE["topk_overlap"] = HY + f""",
tops AS ({_top_parts}),
allp(typology_a, typology_b) AS (VALUES {_pairs}),
ov AS (
  SELECT allp.typology_a, allp.typology_b,
    (SELECT count(*) FROM tops a JOIN tops b ON a.customer_id = b.customer_id
      WHERE a.typology = allp.typology_a AND b.typology = allp.typology_b) AS overlap,
    (SELECT CAST(floor(count(*) * 0.01) AS BIGINT) FROM an) AS top_n
  FROM allp
)
""" + sql_select(["typology_a", "typology_b", "overlap", "top_n"], "ov",
                 {"typology_a": "s", "typology_b": "s", "overlap": "i", "top_n": "i"})

ORACLE["risk_distribution"] = HY + """,
rd AS (
  SELECT 'hybrid_band' AS kind, hybrid_risk_category AS item, count(*) AS n FROM hy GROUP BY hybrid_risk_category
  UNION ALL
  SELECT 'anomaly_band', risk_category, count(*) FROM an GROUP BY risk_category
  UNION ALL
  SELECT 'top1000_typology', primary_typology, count(*) FROM
    (SELECT primary_typology FROM an ORDER BY if_score_max DESC NULLS LAST, customer_id LIMIT 1000)
    GROUP BY primary_typology
)
""" + sql_select(["kind", "item", "n"], "rd")

from .queries import CORR_COMPONENTS, SUMMARY_SCORES  # noqa: E402

ORACLE["score_summary"] = HY + ",\nss2 AS (\n  " + "\n  UNION ALL ".join(
    f"SELECT {_sq(s)} AS score, avg({s}) AS mean, quantile_cont({s}, 0.25) AS p25, quantile_cont({s}, 0.5) AS p50, "
    f"quantile_cont({s}, 0.75) AS p75, quantile_cont({s}, 0.95) AS p95, max({s}) AS max, "
    f"count(*) FILTER (WHERE {s} > 0) AS n_positive FROM hy" for s in SUMMARY_SCORES) + "\n)\n" + sql_select(
    ["score", "mean", "p25", "p50", "p75", "p95", "max", "n_positive"], "ss2",
    {"mean": "d", "p25": "d", "p50": "d", "p75": "d", "p95": "d", "max": "d"})

ORACLE["component_correlation"] = HY + ",\ncc AS (\n  " + "\n  UNION ALL ".join(
    f"SELECT {_sq(c)} AS score, covar_samp({c}, final_hybrid_score) / "
    f"nullif(stddev_samp({c}) * stddev_samp(final_hybrid_score), 0) AS correlation FROM hy" for c in CORR_COMPONENTS
) + "\n)\n" + sql_select(["score", "correlation"], "cc", {"correlation": "d"})


# ---------------------------------------------------------------------------
# evidence queue, requests, responses, narratives
# ---------------------------------------------------------------------------

_CAT_VALUES = ", ".join(f"({_sq(r[0])}, {_sq(r[2])}, {_sq(r[3])}, {_sq(r[4])}, {_sq(r[5])}, {_sq(r[6])})"
                        for r in _K.CATALOGUE)
_LOWCOV = _sq(_K.LOW_COVERAGE_SENTENCE)
_SECONDARY = "concat_ws(' and ', " + ", ".join(
    f"CASE WHEN (rule_{t} > 0 OR if_score_{t} > 0.5) AND primary_rule_typology <> {_sq(_K.TYPOLOGY_LABELS[t])} "
    f"THEN {_sq(_K.TYPOLOGY_LABELS[t].lower())} END" for t in _K.TYPOLOGIES) + ")"

# a quoted field, or one that does not begin with a quote and may hold some
_FIELD = '(?:"(?:[^"]|"")*"|(?:[^",\\n][^,\\n]*)?)'

EVQ = HY + f""",
cat(id, name, risk, typology, channels, cooc) AS (VALUES {_CAT_VALUES}),
ev AS (SELECT hy.*, tr.rule_indicator_trace FROM hy LEFT JOIN tr ON hy.customer_id = tr.customer_id
       WHERE hy.final_hybrid_score > 0.5),
q1 AS (SELECT ev.*, row_number() OVER (ORDER BY final_hybrid_score DESC NULLS LAST, customer_id) AS rank FROM ev),
q2 AS (SELECT *, CAST(floor((rank - 1) / 300) AS INTEGER) AS batch_id FROM q1),
cite AS (
  SELECT t.customer_id,
    string_agg(lower(coalesce(c.name, 'an indicator')) || ' (' || t.ind || ')', ', ' ORDER BY t.g, t.rn) AS cited
  FROM tr_top t LEFT JOIN cat c ON t.ind = c.id GROUP BY t.customer_id
),
nar0 AS (
  SELECT q2.*, cite.cited,
    CASE WHEN if_score_max > 0.8 THEN 'very unusual behaviour' ELSE 'unusual behaviour' END AS strength,
    {_SECONDARY} AS secondary
  FROM q2 LEFT JOIN cite ON q2.customer_id = cite.customer_id
),
nar AS (
  SELECT batch_id, rank, customer_id, concat_ws(' ',
    CASE WHEN rules_triggered > 0
         THEN 'Confirmed rules and ' || strength || ' point towards ' || lower(primary_rule_typology) || '.'
         ELSE 'Only ' || strength || ' led to this review, which could be a sign of '
              || lower(primary_rule_typology) || '.' END,
    CASE WHEN cited IS NOT NULL THEN 'The rules that fired are ' || cited || '.' ELSE 'No rule fired.' END,
    CASE WHEN cluster_primary_typology = primary_rule_typology
           THEN 'Customers who behave alike show the same pattern.'
         WHEN cluster_primary_typology = {_sq(_K.GENERAL_LOW_RISK_LABEL)}
           THEN 'Customers who behave alike are mostly low risk, so this one stands out and should be looked at closely.'
         ELSE 'Customers who behave alike rather show ' || lower(cluster_primary_typology)
              || ', a difference that should be looked at closely.' END,
    CASE WHEN secondary <> '' THEN 'There may also be ' || secondary || '.' END,
    CASE WHEN coverage >= 0.6 THEN {_LOWCOV} END) AS narrative
  FROM nar0
),
nar2 AS (
  SELECT *, CASE WHEN customer_id % 3 = 1 THEN 'Summary "A": ' || narrative ELSE narrative END AS t1 FROM nar
),
nar3 AS (
  SELECT *, CASE WHEN customer_id % 5 = 2 THEN t1 || chr(10) || 'Review advised.' ELSE t1 END
    || CASE WHEN customer_id % 29 = 12 THEN repeat(' more', 40000) ELSE '' END AS t2 FROM nar2
),
lines AS (
  SELECT batch_id, rank,
    CASE WHEN customer_id % 11 = 5 THEN CAST(customer_id AS VARCHAR) || ',"draft"' || chr(10) ELSE '' END
    || CAST(customer_id AS VARCHAR) || ','
    || CASE WHEN customer_id % 17 = 8 THEN 'A 5" margin "as noted"' ELSE '"' || replace(t2, '"', '""') || '"' END
    || CASE WHEN customer_id % 13 = 6 THEN ',"extra"' ELSE '' END AS line
  FROM nar3 WHERE customer_id % 7 <> 3
),
resp0 AS (
  SELECT batch_id, 'customer_id,explanation' || chr(10) || string_agg(line, chr(10) ORDER BY rank) || chr(10)
    || '-' || CAST(batch_id + 1 AS VARCHAR) || ',"unknown id"' AS csv
  FROM lines GROUP BY batch_id
),
resp AS (
  SELECT batch_id, CASE WHEN batch_id % 2 = 1 THEN '```csv' || chr(10) || csv || chr(10) || '```' ELSE csv END
    AS response FROM resp0
),
cleaned AS (
  SELECT batch_id, CASE WHEN starts_with(trim(response), '```')
    THEN trim(regexp_replace(regexp_replace(trim(response), '^```[a-zA-Z0-9_-]*\\n?', ''), '\\n?```$', ''))
    ELSE trim(response) END AS txt
  FROM resp
),
recs0 AS (SELECT batch_id, list_filter(regexp_extract_all(txt, '{_FIELD}(?:,{_FIELD})*'), lambda r: r <> '') AS recs
          FROM cleaned),
recs AS (SELECT batch_id, generate_subscripts(recs, 1) - 1 AS pos, unnest(recs) AS rec FROM recs0),
flds AS (
  SELECT batch_id, pos, list_transform(regexp_extract_all(rec, '(?:^|,)({_FIELD})', 1),
    lambda f: CASE WHEN starts_with(f, '"') THEN replace(substr(f, 2, length(f) - 2), '""', '"') ELSE f END) AS fl
  FROM recs
),
parsed AS (
  SELECT batch_id, pos, len(fl) AS n_fields, trim(fl[1]) AS customer_id,
    CASE WHEN len(fl) >= 2 THEN trim(regexp_replace(fl[2], '[\\r\\n]', ' ', 'g')) END AS explanation,
    CASE WHEN pos = 0 AND len(fl) = 2 AND trim(fl[1]) = 'customer_id' AND trim(fl[2]) = 'explanation'
         THEN 1 ELSE 0 END AS is_header
  FROM flds
),
good AS (SELECT * FROM parsed WHERE is_header = 0 AND n_fields = 2 AND explanation <> ''),
lastans AS (SELECT batch_id, customer_id, arg_max(explanation, pos) AS explanation FROM good
            GROUP BY batch_id, customer_id),
recon AS (
  SELECT q2.batch_id, q2.rank, CAST(q2.customer_id AS VARCHAR) AS customer_id,
    coalesce(l.explanation, 'unsuccessful') AS explanation,
    CASE WHEN l.explanation IS NULL THEN 'unsuccessful' ELSE 'ok' END AS status
  FROM q2 LEFT JOIN lastans l ON q2.batch_id = l.batch_id AND CAST(q2.customer_id AS VARCHAR) = l.customer_id
)"""

ORACLE["evidence_batches"] = EVQ + """,
eb AS (
  SELECT batch_id, count(*) AS n_customers, min(rank) AS first_rank, max(rank) AS last_rank,
    string_agg(CAST(customer_id AS VARCHAR), ',' ORDER BY rank) AS customer_ids,
    min(final_hybrid_score) AS min_score, max(final_hybrid_score) AS max_score
  FROM q2 WHERE rank <= 600 GROUP BY batch_id
)
""" + sql_select(["batch_id", "n_customers", "first_rank", "last_rank", "customer_ids", "min_score", "max_score"],
                 "eb", {"min_score": "d", "max_score": "d"})

_REQ_KINDS = {f"rule_{t}": "i" for t in _K.TYPOLOGIES}
ORACLE["request_records"] = EVQ + "," + _trace_counts_cte("q2") + """,
rr AS (SELECT q2.* EXCLUDE (""" + ", ".join(f"rule_{t}" for t in _K.TYPOLOGIES) + "), " + ", ".join(
    f"tc.n_{t} AS rule_{t}" for t in _K.TYPOLOGIES) + """
       FROM q2 JOIN tc ON q2.customer_id = tc.customer_id)
""" + sql_select(["batch_id", "rank", *_K.REQUEST_FIELDS], "rr", _REQ_KINDS)

ORACLE["narratives"] = EVQ + "\n" + sql_select(["batch_id", "rank", "customer_id", "narrative"], "nar",
                                               {"narrative": "s"})

ORACLE["parse_responses"] = EVQ + "\n" + sql_select(
    ["batch_id", "pos", "n_fields", "customer_id", "explanation", "is_header"], "parsed", {"customer_id": "s"})

ORACLE["reconcile_responses"] = EVQ + "\n" + sql_select(
    ["batch_id", "rank", "customer_id", "explanation", "status"], "recon", {"customer_id": "s"})

ORACLE["response_batch_checks"] = EVQ + """,
reqs AS (SELECT batch_id, CAST(customer_id AS VARCHAR) AS customer_id FROM q2),
body AS (SELECT * FROM parsed WHERE is_header = 0),
per AS (
  SELECT batch_id, max(is_header) AS header_ok, count(*) FILTER (WHERE is_header = 0) AS n_rows,
    count(*) FILTER (WHERE is_header = 0 AND n_fields <> 2) AS malformed_rows
  FROM parsed GROUP BY batch_id
),
unk AS (
  SELECT batch_id, count(*) AS unknown_ids FROM body b
  WHERE NOT EXISTS (SELECT 1 FROM reqs r WHERE r.batch_id = b.batch_id AND r.customer_id = b.customer_id)
  GROUP BY batch_id
),
mis AS (
  SELECT batch_id, count(*) AS missing_ids FROM reqs r
  WHERE NOT EXISTS (SELECT 1 FROM body b WHERE r.batch_id = b.batch_id AND r.customer_id = b.customer_id)
  GROUP BY batch_id
),
nreq AS (SELECT batch_id, count(*) AS n_requested FROM reqs GROUP BY batch_id),
chk AS (
  SELECT nreq.batch_id, nreq.n_requested, coalesce(per.header_ok, 0) AS header_ok, coalesce(per.n_rows, 0) AS n_rows,
    coalesce(per.malformed_rows, 0) AS malformed_rows, coalesce(unk.unknown_ids, 0) AS unknown_ids,
    coalesce(mis.missing_ids, 0) AS missing_ids
  FROM nreq LEFT JOIN per ON nreq.batch_id = per.batch_id LEFT JOIN unk ON nreq.batch_id = unk.batch_id
  LEFT JOIN mis ON nreq.batch_id = mis.batch_id
),
chk2 AS (
  SELECT *, CASE WHEN header_ok = 1 AND malformed_rows = 0 AND n_rows = n_requested AND unknown_ids = 0
                  AND missing_ids = 0 THEN 1 ELSE 0 END AS strict_ok FROM chk
)
""" + sql_select(["batch_id", "n_requested", "header_ok", "n_rows", "malformed_rows", "unknown_ids", "missing_ids",
                  "strict_ok"], "chk2")

_CAT_IDS = ", ".join(_sq(r[0]) for r in _K.CATALOGUE)
ORACLE["narrative_checks"] = EVQ + f""",
nc0 AS (
  SELECT nar.customer_id, nar.narrative, q2.coverage,
    regexp_extract_all(nar.narrative, '[A-Z]+(?:-[A-Z]+)?-[0-9]+') AS ids
  FROM nar JOIN q2 ON nar.customer_id = q2.customer_id
),
nc AS (
  SELECT customer_id, length(narrative) AS n_chars,
    len(regexp_extract_all(narrative, '[.!?](\\s|$)')) AS n_sentences,
    len(ids) AS n_ids,
    len(list_filter(ids, lambda x: x NOT IN ({_CAT_IDS}))) AS n_unknown_ids,
    CASE WHEN strpos(narrative, {_LOWCOV}) > 0 THEN 1 ELSE 0 END AS has_low_cov_sentence,
    CASE WHEN coverage >= 0.6 THEN 1 ELSE 0 END AS needs_low_cov_sentence,
    CASE WHEN regexp_matches(narrative, '[0-9]\\.[0-9]') THEN 1 ELSE 0 END AS has_decimal,
    CASE WHEN regexp_matches(lower(narrative),
      '(if_score|rule_|cluster_|kmeans|dynamic_score|final_hybrid|coverage|isolation forest|_risk\\b)')
      THEN 1 ELSE 0 END AS has_internal_name
  FROM nc0
),
nc2 AS (
  SELECT *, CASE WHEN n_chars <= {_K.NARRATIVE_MAX_CHARS} AND n_sentences BETWEEN {_K.NARRATIVE_MIN_SENTENCES}
    AND {_K.NARRATIVE_MAX_SENTENCES} AND n_unknown_ids = 0 AND has_low_cov_sentence = needs_low_cov_sentence
    AND has_decimal = 0 AND has_internal_name = 0 THEN 1 ELSE 0 END AS passed
  FROM nc
)
""" + sql_select(["customer_id", "n_chars", "n_sentences", "n_ids", "n_unknown_ids", "has_low_cov_sentence",
                  "needs_low_cov_sentence", "has_decimal", "has_internal_name", "passed"], "nc2",
                 {"n_chars": "i", "n_sentences": "i", "n_ids": "i", "n_unknown_ids": "i",
                  "has_low_cov_sentence": "i", "needs_low_cov_sentence": "i", "has_decimal": "i",
                  "has_internal_name": "i"})


# ---------------------------------------------------------------------------
# catalogue and lookups
# ---------------------------------------------------------------------------

_RULE_IDS = ", ".join(f"({_sq(i)})" for _, _, i in R.indicator_ids())
_FIRED = " UNION ALL ".join(
    f"SELECT customer_id, {_sq(i)} AS indicator_id FROM rp0 WHERE \"{_ind_alias(i)}\" > 0"
    for _, _, i in R.indicator_ids())
CATQ = EVQ + f""",
rids(indicator_id) AS (VALUES {_RULE_IDS}),
fired AS ({_FIRED}),
edges0 AS (SELECT id AS src, unnest(string_split(cooc, ', ')) AS dst FROM cat),
edges AS (
  SELECT e.src, e.dst,
    CASE WHEN EXISTS (SELECT 1 FROM edges0 r WHERE r.src = e.dst AND r.dst = e.src) THEN 1 ELSE 0 END AS has_reverse,
    CASE WHEN EXISTS (SELECT 1 FROM cat c WHERE c.id = e.dst) THEN 1 ELSE 0 END AS dst_in_catalogue
  FROM edges0 e
)"""

ORACLE["catalogue_summary"] = CATQ + """,
tt AS (SELECT typology, unnest(string_split(channels, ', ')) AS tx FROM cat),
per AS (
  SELECT typology, count(*) AS n_indicators, count(*) FILTER (WHERE risk = 'High') AS n_high,
    count(*) FILTER (WHERE risk = 'Medium') AS n_medium, count(*) FILTER (WHERE risk = 'Low') AS n_low,
    count(*) FILTER (WHERE id IN (SELECT indicator_id FROM rids)) AS n_with_rule
  FROM cat GROUP BY typology
),
ntt AS (SELECT typology, count(DISTINCT tx) AS n_transaction_types FROM tt GROUP BY typology),
fc AS (
  SELECT c.typology, count(DISTINCT f.customer_id) AS n_customers_fired, count(DISTINCT f.indicator_id) AS n_indicators_fired
  FROM fired f JOIN cat c ON f.indicator_id = c.id GROUP BY c.typology
),
cs AS (
  SELECT per.*, ntt.n_transaction_types, coalesce(fc.n_customers_fired, 0) AS n_customers_fired,
    coalesce(fc.n_indicators_fired, 0) AS n_indicators_fired
  FROM per JOIN ntt ON per.typology = ntt.typology LEFT JOIN fc ON per.typology = fc.typology
)
""" + sql_select(["typology", "n_indicators", "n_high", "n_medium", "n_low", "n_transaction_types", "n_with_rule",
                  "n_customers_fired", "n_indicators_fired"], "cs", {"n_with_rule": "i"})

ORACLE["cooccurrence_edges"] = CATQ + """,
both_fired AS (
  SELECT e.src, e.dst, count(*) AS n FROM edges e JOIN fired a ON a.indicator_id = e.src
  JOIN fired b ON b.customer_id = a.customer_id AND b.indicator_id = e.dst GROUP BY e.src, e.dst
),
eo AS (
  SELECT e.*, coalesce(bf.n, 0) AS n_customers_both FROM edges e
  LEFT JOIN both_fired bf ON e.src = bf.src AND e.dst = bf.dst
)
""" + sql_select(["src", "dst", "has_reverse", "dst_in_catalogue", "n_customers_both"], "eo",
                 {"src": "s", "dst": "s", "has_reverse": "i", "dst_in_catalogue": "i", "n_customers_both": "i"})

ORACLE["cooccurrence_observed"] = CATQ + """,
tp AS (
  SELECT least(a.ind, b.ind) AS ind_a, greatest(a.ind, b.ind) AS ind_b, count(*) AS n_customers
  FROM tr_top a JOIN tr_top b ON a.customer_id = b.customer_id AND a.rn < b.rn
  GROUP BY least(a.ind, b.ind), greatest(a.ind, b.ind)
),
und AS (SELECT DISTINCT least(src, dst) AS ind_a, greatest(src, dst) AS ind_b FROM edges),
co AS (
  SELECT tp.*, CASE WHEN und.ind_a IS NULL THEN 0 ELSE 1 END AS catalogued
  FROM tp LEFT JOIN und ON tp.ind_a = und.ind_a AND tp.ind_b = und.ind_b
)
""" + sql_select(["ind_a", "ind_b", "n_customers", "catalogued"], "co",
                 {"ind_a": "s", "ind_b": "s", "catalogued": "i"})

_IMCC = ", ".join(f"({_sq(i)}, {_sq(str(m))})" for i, codes in _K.INDICATOR_MCC.items() for m in codes)
_MCC_ROWS = ", ".join(f"({c}, {_K.MCC_RANGES.get(c, c)}, {_sq(d)})" for c, d in _K.MCC_DESCRIPTIONS.items())
_DESCRIBED = f"""mccs(low, high, description) AS (VALUES {_MCC_ROWS}),
ds AS (SELECT DISTINCT t.mcc, arg_min(m.description, (m.high - m.low) * 10000 + m.low) AS description
       FROM (SELECT DISTINCT mcc FROM txn) t JOIN mccs m ON TRY_CAST(t.mcc AS INTEGER) BETWEEN m.low AND m.high GROUP BY t.mcc)"""
ORACLE["mcc_indicator_hits"] = CATQ + f""",
imcc(indicator_id, mcc) AS (VALUES {_IMCC}),
{_DESCRIBED},
mh AS (
  SELECT m.indicator_id, count(*) AS n_txn, count(DISTINCT t.customer_id) AS n_customers,
    sum(t.amount_cad) AS total_amount, count(DISTINCT t.mcc) AS n_mcc_seen,
    coalesce(string_agg(DISTINCT ds.description, '; ' ORDER BY ds.description), '') AS descriptions
  FROM txn t JOIN imcc m ON t.mcc = m.mcc LEFT JOIN ds ON t.mcc = ds.mcc WHERE t.channel = 'Card' GROUP BY m.indicator_id
)
""" + sql_select(["indicator_id", "n_txn", "n_customers", "total_amount", "n_mcc_seen", "descriptions"], "mh",
                 {"n_txn": "i", "total_amount": "d", "descriptions": "s"})

ORACLE["card_mcc_profile"] = TXN + f""",
{_DESCRIBED},
mp AS (SELECT t.mcc, any_value(ds.description) AS description, count(*) AS n_txn, sum(t.amount_cad) AS total_amount
       FROM txn t LEFT JOIN ds ON t.mcc = ds.mcc WHERE t.channel = 'Card' GROUP BY t.mcc)
""" + sql_select(["mcc", "description", "n_txn", "total_amount"], "mp", {"mcc": "s", "description": "s"})

ORACLE["rule_catalogue_gap"] = CATQ + """,
allids AS (SELECT id AS indicator_id FROM cat UNION SELECT indicator_id FROM rids),
fcnt AS (SELECT indicator_id, count(DISTINCT customer_id) AS n FROM fired GROUP BY indicator_id),
rcg AS (
  SELECT a.indicator_id,
    CASE WHEN a.indicator_id IN (SELECT id FROM cat) THEN 1 ELSE 0 END AS in_catalogue,
    CASE WHEN a.indicator_id IN (SELECT indicator_id FROM rids) THEN 1 ELSE 0 END AS has_rule,
    coalesce(f.n, 0) AS n_customers_fired
  FROM allids a LEFT JOIN fcnt f ON a.indicator_id = f.indicator_id
)
""" + sql_select(["indicator_id", "in_catalogue", "has_rule", "n_customers_fired"], "rcg",
                 {"in_catalogue": "i", "has_rule": "i", "n_customers_fired": "i"})


# ---------------------------------------------------------------------------
# sink round trip and streaming
# ---------------------------------------------------------------------------

ORACLE["src_sink_roundtrip"] = ORACLE["src_channel_scan"]

ORACLE["stream_daily_flow"] = TXN + """,
sdf AS (
  SELECT customer_id, CAST(transaction_datetime AS DATE) AS day, count(*) AS n_txn,
    coalesce(sum(amount_cad), 0.0) AS volume,
    coalesce(sum(amount_cad) FILTER (WHERE debit_credit = 'C'), 0.0) AS inflow,
    coalesce(sum(amount_cad) FILTER (WHERE debit_credit = 'D'), 0.0) AS outflow,
    count(amount_cad) FILTER (WHERE amount_cad < 10000) AS count_below_10k,
    count(*) FILTER (WHERE amount_cad >= 9000 AND amount_cad < 10000) AS count_near_10k
  FROM txn WHERE transaction_datetime IS NOT NULL GROUP BY customer_id, CAST(transaction_datetime AS DATE)
)
""" + sql_select(["customer_id", "day", "n_txn", "volume", "inflow", "outflow", "count_below_10k",
                  "count_near_10k"], "sdf", {"day": "date"})


ORACLE["high_risk_extracts"] = HY + """,
hr AS (
  SELECT customer_id, if_score_max, final_hybrid_score,
    CASE WHEN if_score_max > 0.6 THEN 1 ELSE 0 END AS in_anomaly_extract,
    CASE WHEN final_hybrid_score > 0.6 THEN 1 ELSE 0 END AS in_hybrid_extract
  FROM hy WHERE if_score_max > 0.6 OR final_hybrid_score > 0.6
)
""" + sql_select(["customer_id", "in_anomaly_extract", "in_hybrid_extract", "if_score_max", "final_hybrid_score"],
                 "hr", {"in_anomaly_extract": "i", "in_hybrid_extract": "i"})


ORACLE["sink_results"] = HY + """,
both_kinds AS (
  SELECT customer_id, final_hybrid_score, 'all' AS kind FROM hy
  UNION ALL
  SELECT customer_id, final_hybrid_score, 'high_risk' FROM hy WHERE final_hybrid_score > 0.6
)
""" + sql_select(["customer_id", "final_hybrid_score", "kind"], "both_kinds", {"kind": "s"})

ORACLE["sink_explanations"] = EVQ + "\n" + sql_select(["customer_id", "explanation"], "recon", {"customer_id": "s"})


ORACLE["hour_entropy"] = TXN + """,
per AS (SELECT customer_id, hour, count(*) AS n FROM txn WHERE hour IS NOT NULL GROUP BY customer_id, hour),
tot AS (SELECT customer_id, sum(n) AS n_rows FROM per GROUP BY customer_id),
ent AS (SELECT p.customer_id, t.n_rows, greatest(0.0, -sum(n / CAST(n_rows AS DOUBLE) * ln(n / CAST(n_rows AS DOUBLE))))
          AS hour_entropy_score FROM per p JOIN tot t ON p.customer_id = t.customer_id GROUP BY p.customer_id, t.n_rows)
""" + sql_select(["customer_id", "n_rows", "hour_entropy_score"], "ent")

ORACLE["card_retail_avg"] = TXN + """,
ret AS (SELECT customer_id, count(amount_cad) AS n_retail, avg(amount_cad) AS avg_retail_amount FROM txn
        WHERE channel = 'Card' AND mcc IN ('5300', '5310', '5331', '5411', '5499', '5912') GROUP BY customer_id)
""" + sql_select(["customer_id", "n_retail", "avg_retail_amount"], "ret")

ORACLE["geo_volume_z"] = TXN + """,
per AS (SELECT customer_id, city, sum(amount_cad) AS volume FROM txn WHERE city IS NOT NULL GROUP BY customer_id, city),
gz AS (SELECT customer_id, city, volume, (volume - avg(volume) OVER c) / nullif(stddev_samp(volume) OVER c, 0) AS volume_score
       FROM per WINDOW c AS (PARTITION BY city))
""" + sql_select(["customer_id", "city", "volume", "volume_score"], "gz")

ORACLE["hotel_cash_match"] = TXN + """,
hot AS (SELECT customer_id, city, date, count(*) AS n_hotel, sum(amount_cad) AS hotel_amount FROM txn
        WHERE channel = 'Card' AND mcc IN ('7011', '7012') AND city IS NOT NULL AND date IS NOT NULL GROUP BY ALL),
csh AS (SELECT customer_id, city, date AS cash_date, count(*) AS n_cash, sum(amount_cad) AS cash_amount FROM txn
        WHERE channel = 'ABM' AND city IS NOT NULL AND date IS NOT NULL GROUP BY ALL),
hcm AS (SELECT h.customer_id, h.city, h.date, c.cash_date, n_hotel, hotel_amount, n_cash, cash_amount FROM hot h JOIN csh c
        ON h.customer_id = c.customer_id AND h.city = c.city AND c.cash_date - h.date BETWEEN 0 AND 1)
""" + sql_select(["customer_id", "city", "date", "cash_date", "n_hotel", "hotel_amount", "n_cash", "cash_amount"], "hcm",
                 {"cash_date": "date"})

ORACLE["same_day_turnover"] = TXN + """,
cr AS (SELECT customer_id, transaction_datetime, sum(amount_cad) AS credit FROM txn
       WHERE debit_credit = 'C' AND amount_cad > 0 AND transaction_datetime IS NOT NULL GROUP BY ALL),
db AS (SELECT customer_id, transaction_datetime AS at, amount_cad FROM txn
       WHERE debit_credit = 'D' AND amount_cad > 0 AND transaction_datetime IS NOT NULL),
used AS (SELECT cr.customer_id, cr.transaction_datetime, count(*) AS n_debits, sum(db.amount_cad) AS debit_24h
         FROM db ASOF JOIN cr ON db.customer_id = cr.customer_id AND db.at >= cr.transaction_datetime
         WHERE db.at <= cr.transaction_datetime + INTERVAL 24 HOURS GROUP BY ALL),
sdt AS (SELECT cr.customer_id, cr.transaction_datetime, cr.credit, coalesce(n_debits, 0) AS n_debits,
          coalesce(debit_24h, 0.0) AS debit_24h, least(cr.credit, coalesce(debit_24h, 0.0)) AS turnover
        FROM cr LEFT JOIN used USING (customer_id, transaction_datetime))
""" + sql_select(["customer_id", "transaction_datetime", "credit", "n_debits", "debit_24h", "turnover"], "sdt")

ORACLE["stream_structuring_alerts"] = TXN + """,
near AS (SELECT customer_id, transaction_datetime AS ts FROM txn WHERE amount_cad >= 9000 AND amount_cad < 10000
         AND transaction_datetime IS NOT NULL),
slid AS (SELECT customer_id, ts, time_bucket(INTERVAL 6 HOURS, ts, TIMESTAMP '1970-01-01') - to_hours(CAST(6 * i AS INTEGER))
           AS opens FROM near, range(4) r(i)),
bursts AS (SELECT customer_id, min(ts) AS first_time FROM slid GROUP BY customer_id, opens HAVING count(*) >= 2),
al AS (SELECT DISTINCT customer_id, first_time FROM bursts)
""" + sql_select(["customer_id", "first_time"], "al", {"first_time": "ts"})

ORACLE["stream_late_rows"] = TXN + """,
lt AS (SELECT customer_id, CAST(transaction_datetime AS DATE) AS day, count(*) AS n_late,
         coalesce(sum(amount_cad), 0.0) AS late_volume
       FROM txn WHERE customer_id % 10 = 3 AND month(transaction_datetime) <= 3 GROUP BY ALL)
""" + sql_select(["customer_id", "day", "n_late", "late_volume"], "lt", {"day": "date"})

ORACLE["src_rejected_rows"] = TXN + """,
rj AS (SELECT channel AS item, count(*) AS n_good, count(DISTINCT customer_id) FILTER (WHERE customer_id % 7 = 0) AS n_rejected
       FROM txn GROUP BY channel
       UNION ALL SELECT 'kyc_individual', count(*) FILTER (WHERE cid % 50 <> 5), count(*) FILTER (WHERE cid % 50 = 5)
       FROM (SELECT DISTINCT c_custkey // 10 AS cid FROM customer) WHERE cid % 4 < 3)
""" + sql_select(["item", "n_good", "n_rejected"], "rj")

ORACLE["src_export_features"] = KYCF + """,
lost AS (SELECT *, customer_id % 50 = 5 AND customer_id % 4 < 3 AS is_lost FROM kf),
xf AS (SELECT customer_id, transaction_count_total, total_volume, card_luxury_sum, sales,
         CASE WHEN is_lost THEN 0 ELSE occupation_risk_high END AS occupation_risk_high,
         CASE WHEN NOT is_lost THEN age END AS age, CASE WHEN NOT is_lost THEN customer_tenure_days END AS customer_tenure_days
       FROM lost)
""" + sql_select(["customer_id", "transaction_count_total", "total_volume", "card_luxury_sum", "occupation_risk_high",
                  "sales", "age", "customer_tenure_days"], "xf")

ORACLE["model_round_trip"] = TXN + """,
mr AS (SELECT count(DISTINCT customer_id) AS n_customers, 0.0 AS largest_gap, 0 AS n_moved FROM txn)
""" + sql_select(["n_customers", "largest_gap", "n_moved"], "mr")


def _fixed_hash(salt: int) -> str:
    x = f"((w.t * 7919 + w.tree * 104729 + w.node * 1299709 + {salt * 15485863}) % 1000003)"
    return f"({x} * {x} % 1000003)"


_IS_LEAF = f"(w.depth = 7 OR (w.depth > 1 AND {_fixed_hash(3)} % 10 = 0))"
_REST = "CASE n WHEN 1 THEN 0.0 WHEN 2 THEN 1.0 ELSE 2.0 * (ln(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n END"
ORACLE["iforest_fixed_scores"] = FT.replace("WITH", "WITH RECURSIVE", 1) + ANOM_CTES + f""",
typs(t, typology) AS (VALUES {", ".join(f"({i}, {_sq(t)})" for i, t in enumerate(_K.TYPOLOGIES))}),
width AS (SELECT typology, count(*) AS n FROM fs GROUP BY typology),
walk(customer_id, t, typology, tree, node, depth) AS (
  SELECT ft.customer_id, typs.t, typs.typology, CAST(r.i AS BIGINT), CAST(0 AS BIGINT), 0 FROM ft, typs, range(20) r(i)
  UNION ALL
  SELECT w.customer_id, w.t, w.typology, w.tree, 2 * w.node + CASE WHEN p.value < 12.0 * pow(CAST({_fixed_hash(2)} AS DOUBLE) / 1000003, 2)
      THEN 1 ELSE 2 END, w.depth + 1
  FROM walk w JOIN width ON width.typology = w.typology
    JOIN fs ON fs.typology = w.typology AND fs.position = {_fixed_hash(1)} % width.n
    JOIN prep p ON p.customer_id = w.customer_id AND p.typology = w.typology AND p.feature = fs.feature
  WHERE NOT {_IS_LEAF}
),
leaves AS (SELECT w.*, 1 + {_fixed_hash(4)} % 4 AS n FROM walk w WHERE {_IS_LEAF}),
paths AS (SELECT customer_id, typology, avg(depth + {_REST}) AS path FROM leaves GROUP BY ALL),
raw AS (SELECT customer_id, typology, pow(2, -path / (2.0 * (ln(255) + 0.5772156649015329) - 2.0 * 255 / 256)) AS raw FROM paths),
fixed AS (SELECT customer_id, {", ".join(f"max(raw) FILTER (WHERE typology = {_sq(t)}) AS raw_score_{t}" for t in _K.TYPOLOGIES)}
          FROM raw GROUP BY customer_id)
""" + sql_select(["customer_id", *[f"raw_score_{t}" for t in _K.TYPOLOGIES]], "fixed")

ORACLE["catalogue_csv"] = CATQ + """,
ccf AS (SELECT indicator_id, count(DISTINCT customer_id) AS n FROM fired GROUP BY indicator_id),
cc AS (SELECT cat.id AS indicator_id, cat.risk AS risk_level, len(string_split(channels, ', ')) AS n_types,
         len(string_split(cooc, ', ')) AS n_co_occurring, coalesce(ccf.n, 0) AS n_customers
       FROM cat LEFT JOIN ccf ON ccf.indicator_id = cat.id)
""" + sql_select(["indicator_id", "risk_level", "n_types", "n_co_occurring", "n_customers"], "cc", {"risk_level": "s"})

ORACLE["request_payloads"] = ORACLE["request_records"].rsplit("SELECT", 1)[0] + sql_select(
    ["batch_id", "pos", *_K.REQUEST_FIELDS], "(SELECT *, (rank - 1) % 300 AS pos FROM rr)", _REQ_KINDS)
