"""Regulatory indicator rules as data, compiled to Column expressions.

A rule table maps each typology to its indicators; an indicator is a list of
*ladders*; a ladder is an ordered list of (condition, points) steps of which
the first matching one scores. Ladders inside an indicator add up, indicators
add up, and the typology total is clipped to [0, 1].

Conditions are SQL boolean expressions over feature names. Spark parses them
with its own SQL parser (``F.expr``); every referenced feature is first
projected as ``coalesce(cast(x as double), 0)`` (a missing or NULL feature
reads as 0). The same table renders to plain SQL for other engines.

The compiled plan is a projection only: no shuffle, no Python.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K

Ladder = list[tuple[str, float]]
Indicator = tuple[str, list[Ladder]]

# ---------------------------------------------------------------------------
# FIXED VALUES: derived rule inputs
# ---------------------------------------------------------------------------
DERIVED_INPUTS = {
    "card_surge_ratio": "CASE WHEN card_volume_90d > 0 THEN card_volume_30d / card_volume_90d ELSE 0.0 END",
    "max_eft_emt_debit": "greatest(emt_debit_count, eft_debit_count)",
}

# ---------------------------------------------------------------------------
# FIXED VALUES: indicator thresholds and points, per typology
# ---------------------------------------------------------------------------
RULES: dict[str, list[Indicator]] = {
    "structuring_layering": [
        ("STRUCT-001", [
            [("count_below_10k >= 20", 0.20), ("count_below_10k >= 10", 0.10)],
            [("ratio_below_10k > 0.90 AND count_below_10k >= 10", 0.10)],
            [("cash_struct_count >= 10", 0.15), ("cash_struct_count >= 5", 0.07)],
        ]),
        ("STRUCT-006", [
            [("transactions_per_active_day > 20", 0.20), ("transactions_per_active_day > 10", 0.10)],
            [("volume_per_day > 5000", 0.10), ("volume_per_day > 2000", 0.05)],
        ]),
        ("ATYPICAL-006", [
            [("night_transaction_ratio > 0.60 AND transaction_count_total >= 20", 0.12),
             ("night_transaction_ratio > 0.40", 0.06)],
            [("weekend_ratio > 0.70 AND transaction_count_total >= 20", 0.10)],
        ]),
        ("ATYPICAL-007", [
            [("flow_through_ratio > 0.95 AND total_volume > 100000", 0.40),
             ("flow_through_ratio > 0.90 AND total_volume > 50000", 0.25),
             ("flow_through_ratio > 0.80 AND total_volume > 20000", 0.12)],
            [("count_eft + count_emt > 20 AND flow_through_ratio > 0.70", 0.10)],
        ]),
        ("BEHAV-001", [
            [("unique_cities >= 5", 0.20), ("unique_cities >= 3", 0.10)],
            [("unique_provinces >= 3", 0.10), ("unique_provinces >= 2", 0.05)],
        ]),
        ("PROF-006", [
            [("total_volume > 500000 AND income > 0 AND spending_to_income_ratio > 5", 0.30),
             ("total_volume > 200000 AND income > 0 AND spending_to_income_ratio > 3", 0.18)],
            [("volume_per_day > 10000", 0.15), ("volume_per_day > 3000", 0.08)],
        ]),
        ("PROF-007", [
            [("ratio_round_100 > 0.80 AND transaction_count_total >= 20", 0.15),
             ("ratio_round_100 > 0.60 AND transaction_count_total >= 20", 0.08)],
            [("ratio_round_1000 > 0.40 AND transaction_count_total >= 10", 0.10)],
            [("count_round_1000 >= 5", 0.05)],
        ]),
    ],
    "behavioural_profile": [
        ("ACCT-001", [
            [("max_days_between_txns > 180 AND total_volume > 10000", 0.25),
             ("max_days_between_txns > 90 AND total_volume > 5000", 0.15)],
            [("monthly_volume_cv > 3.0 AND customer_tenure_days > 180", 0.12)],
        ]),
        ("ACCT-002", [
            [("monthly_txn_count_std > 50", 0.12)],
            [("monthly_volume_cv > 2.0 AND active_days < time_span_days * 0.30", 0.15)],
            [("channel_concentration_hhi > 0.85 AND monthly_txn_count_std > 20", 0.08)],
        ]),
        ("ACCT-003", [
            [("card_surge_ratio > 0.75 AND card_volume_30d > 10000", 0.20),
             ("card_surge_ratio > 0.50 AND card_volume_30d > 5000", 0.10)],
            [("income > 0 AND sum_card > income * 0.70 AND sum_card > 20000", 0.15)],
            [("amount_cv > 2.0 AND count_card > 20", 0.08)],
        ]),
        ("ACCT-004", [
            [("monthly_volume_cv > 2.5", 0.15)],
            [("monthly_txn_count_std > 30", 0.10)],
            [("amount_cv > 3.0", 0.12)],
            [("std_transaction_amount > 5000", 0.08)],
        ]),
        ("PROD-008", [
            [("sum_card > 50000", 0.20), ("sum_card > 20000", 0.10)],
            [("card_luxury_sum > 15000 AND (income = 0 OR spending_to_income_ratio > 3)", 0.20)],
            [("card_luxury_count >= 5 AND income > 0 AND card_luxury_sum > income * 0.5", 0.10)],
        ]),
        ("PROF-001", [
            [("income > 0 AND income_vol_ratio > 50", 0.20), ("income > 0 AND income_vol_ratio > 20", 0.10)],
            [("total_volume > 100000 AND customer_tenure_days < 180", 0.15)],
        ]),
        ("PROF-002", [
            [("income > 0 AND total_outflow > 10000 AND spending_to_income_ratio > 10", 0.35),
             ("income > 0 AND total_outflow > 10000 AND spending_to_income_ratio > 5", 0.18)],
        ]),
        ("PROF-005", [
            [("income > 0 AND spending_to_income_ratio > 5", 0.20),
             ("income > 0 AND spending_to_income_ratio > 3", 0.10)],
            [("card_luxury_sum > 5000 AND spending_to_income_ratio > 2", 0.10)],
        ]),
        ("PROF-008", [
            [("amount_cv > 3.0 AND transaction_count_total >= 20", 0.15)],
            [("max_transaction_amount > 50000 AND (income = 0 OR max_transaction_amount > income * 2)", 0.20)],
            [("avg_transaction_amount > 10000 AND is_individual = 1", 0.12)],
        ]),
        ("PROF-010", [
            [("monthly_volume_cv > 3.0", 0.20), ("monthly_volume_cv > 2.0", 0.10)],
            [("monthly_txn_count_std > 40 AND monthly_volume_cv > 1.5", 0.12)],
            [("amount_cv > 4.0", 0.10)],
        ]),
    ],
    "trade_shell": [
        ("GATE-001", [
            [("is_business = 1 AND flow_through_ratio > 0.92 AND total_volume > 200000", 0.35),
             ("is_business = 1 AND flow_through_ratio > 0.85 AND total_volume > 100000", 0.20)],
            [("total_volume > 100000 AND abs(net_flow) < total_volume * 0.02", 0.15)],
        ]),
        ("PML-TBML-02", [
            [("industry_risk_high = 1 AND volume_to_sales_ratio > 5", 0.25),
             ("industry_risk_high = 1 AND volume_to_sales_ratio > 2", 0.12)],
            [("is_business = 1 AND industry_risk_high = 1 AND count_wire > 5", 0.10)],
        ]),
        ("PML-TBML-03", [
            [("is_business = 1 AND count_wire > 20", 0.25), ("is_business = 1 AND count_wire > 10", 0.12)],
            [("is_business = 1 AND count_eft > 50", 0.15)],
            [("sum_wire > 500000", 0.20)],
        ]),
        ("PML-TBML-04", [
            [("eft_credit_sum > 500000", 0.35), ("eft_credit_sum > 100000", 0.18)],
            [("monthly_txn_cv > 2.0 AND eft_credit_sum > 50000", 0.10)],
            [("is_business = 1 AND inflow_per_day > 5000", 0.10)],
        ]),
        ("PML-TBML-08", [
            [("is_business = 1 AND ratio_round_1000 > 0.60", 0.20),
             ("is_business = 1 AND ratio_round_1000 > 0.40", 0.10)],
            [("is_business = 1 AND count_round_1000 >= 10", 0.10)],
        ]),
        ("PROF-004", [
            [("sales > 0 AND total_volume > 50000 AND volume_to_sales_ratio > 20", 0.30),
             ("sales > 0 AND total_volume > 50000 AND volume_to_sales_ratio > 10", 0.15)],
            [("is_business = 1 AND employee_count <= 2 AND sales > 0 AND volume_to_sales_ratio > 20", 0.20)],
        ]),
    ],
    "cross_border_geo": [
        ("GEO-001", [
            [("drug_country_txn_count >= 5", 0.25), ("drug_country_txn_count >= 1", 0.12)],
        ]),
        ("GEO-002", [
            [("high_risk_fatf_txn_count >= 3", 0.55), ("high_risk_fatf_txn_count >= 1", 0.40)],
        ]),
        ("GEO-003", [
            [("greylist_txn_count >= 10", 0.18), ("greylist_txn_count >= 3", 0.10)],
            [("offshore_center_txn_count >= 3", 0.18), ("offshore_center_txn_count >= 1", 0.10)],
            [("underground_banking_country_count >= 2", 0.10)],
        ]),
        ("GEO-004", [
            [("has_any_high_risk_txn = 1", 0.10)],
        ]),
        ("GEO-005", [
            [("international_ratio > 0.80 AND international_txn_count >= 10", 0.18),
             ("international_ratio > 0.50 AND international_txn_count >= 5", 0.10)],
            [("unique_countries >= 5", 0.10)],
            [("sum_westernunion > 10000", 0.12), ("sum_westernunion > 1000", 0.06)],
            [("count_westernunion >= 5", 0.08)],
            [("card_unique_countries >= 4", 0.08)],
        ]),
        ("WIRE-008", [
            [("sum_wire > 500000", 0.30), ("sum_wire > 100000", 0.15)],
            [("income > 0 AND sum_wire > income", 0.10)],
        ]),
        ("WIRE-010", [
            [("count_wire >= 15", 0.18), ("count_wire >= 8", 0.10)],
        ]),
    ],
    "human_trafficking": [
        ("HT-SEX-01", [
            [("card_retail_count >= 10 AND ratio_round_100 > 0.50", 0.18),
             ("card_retail_count >= 5 AND ratio_round_100 > 0.50", 0.10)],
        ]),
        ("HT-SEX-02", [
            [("card_retail_count >= 10 AND avg_transaction_amount > 200", 0.12)],
        ]),
        ("HT-SEX-03", [
            [("card_luxury_sum > 10000 AND (income = 0 OR spending_to_income_ratio > 3)", 0.28),
             ("card_luxury_sum > 5000 AND (income = 0 OR spending_to_income_ratio > 2)", 0.15)],
            [("card_luxury_count >= 5", 0.08)],
        ]),
        ("HT-SEX-04", [
            [("card_parking_count >= 20 AND unique_cities >= 3", 0.15), ("card_parking_count >= 10", 0.08)],
        ]),
        ("HT-SEX-05", [
            [("card_delivery_count >= 20 AND card_accommodation_count >= 3", 0.15),
             ("card_delivery_count >= 10", 0.08)],
        ]),
        ("HT-SEX-06", [
            [("card_digital_count >= 5", 0.15), ("card_digital_count >= 2", 0.08)],
        ]),
        ("HT-SEX-07", [
            [("unique_cities >= 5 AND night_abm_count >= 5", 0.35),
             ("unique_cities >= 3 AND night_abm_count >= 3", 0.22),
             ("unique_cities >= 3 AND night_abm_count >= 1", 0.12)],
        ]),
        ("HT-SEX-08", [
            [("card_accommodation_count >= 5", 0.18), ("card_accommodation_count >= 3", 0.12)],
            [("card_accommodation_sum > 2000", 0.08)],
        ]),
        ("HT-SEX-10", [
            [("ht_source_country_txn_count >= 5", 0.25), ("ht_source_country_txn_count >= 3", 0.15)],
            [("card_travel_sum > 5000", 0.22), ("card_travel_sum > 2000", 0.12)],
            [("sum_westernunion > 2000 AND ht_source_country_txn_count >= 1", 0.10)],
        ]),
        ("HT-SEX-12", [
            [("card_adult_afterhours_count >= 3", 0.45),
             ("card_adult_afterhours_count >= 1", 0.28),
             ("card_afterhours_count >= 10 AND night_transaction_ratio > 0.40 AND transaction_count_total >= 10", 0.12)],
        ]),
        ("HT-SEX-13", [
            [("income > 0 AND total_volume > 50000 AND spending_to_income_ratio > 10", 0.18),
             ("income > 0 AND total_volume > 200000 AND spending_to_income_ratio > 5", 0.12)],
        ]),
        ("HT-SEX-14", [
            [("max_eft_emt_debit >= 8", 0.18), ("max_eft_emt_debit >= 4", 0.10)],
        ]),
    ],
}

_IDENT = re.compile(r"\b[a-z_][a-z0-9_]*\b")
_SQL_WORDS = {"and", "or", "not", "abs", "case", "when", "then", "else", "end", "greatest", "least"}


def referenced_features(rules: dict[str, list[Indicator]] = RULES) -> list[str]:
    """Feature columns the rule table reads (derived inputs expanded)."""
    names: list[str] = []

    def add(expr: str) -> None:
        for tok in _IDENT.findall(expr):
            if tok in _SQL_WORDS or tok in DERIVED_INPUTS:
                continue
            if tok not in names:
                names.append(tok)

    for expr in DERIVED_INPUTS.values():
        add(expr)
    for inds in rules.values():
        for _, ladders in inds:
            for ladder in ladders:
                for cond, _ in ladder:
                    add(cond)
    return names


def indicator_ids(rules: dict[str, list[Indicator]] = RULES) -> list[tuple[int, str, str]]:
    """(ordinal, typology, indicator id) in column order."""
    out, i = [], 0
    for typ in K.TYPOLOGIES:
        for ind, _ in rules[typ]:
            out.append((i, typ, ind))
            i += 1
    return out


def ladder_sql(ladder: Ladder) -> str:
    whens = " ".join(f"WHEN {c} THEN CAST({p!r} AS DOUBLE)" for c, p in ladder)
    return f"(CASE {whens} ELSE CAST(0.0 AS DOUBLE) END)"


def indicator_sql(ladders: list[Ladder]) -> str:
    return "(" + " + ".join(ladder_sql(lad) for lad in ladders) + ")"


def rule_inputs(features: DataFrame, rules: dict[str, list[Indicator]] = RULES) -> DataFrame:
    """Keep customer_id + every referenced feature as a non-null double, plus
    the derived inputs. Features absent from the table read as 0."""
    present = set(features.columns)
    cols = [F.col("customer_id")]
    for name in referenced_features(rules):
        c = F.coalesce(F.col(name).cast("double"), F.lit(0.0)) if name in present else F.lit(0.0)
        cols.append(c.alias(name))
    base = features.select(*cols)
    return base.select("*", *[F.expr(e).cast("double").alias(n) for n, e in DERIVED_INPUTS.items()])


def indicator_column_name(typ: str, ind: str) -> str:
    return f"{K.TYPOLOGY_PREFIX[typ]}::{ind}"


def typology_points(typ: str, rules: dict[str, list[Indicator]] = RULES) -> list[Column]:
    """One points column per indicator of ``typ``."""
    return [F.expr(indicator_sql(ladders)).alias(indicator_column_name(typ, ind))
            for ind, ladders in rules[typ]]


def clip01_sum(cols: list[str]) -> Column:
    s = F.col(f"`{cols[0]}`")
    for c in cols[1:]:
        s = s + F.col(f"`{c}`")
    return F.when(s < 0, F.lit(0.0)).when(s > 1, F.lit(1.0)).otherwise(s)


def rule_points(features: DataFrame, rules: dict[str, list[Indicator]] = RULES,
                keep: list[str] | None = None) -> DataFrame:
    """customer_id + one points column per indicator (``Prefix::ID``) + one
    clipped score per typology (``rule_<typology>``). Each typology is its
    own projection so no generated method grows past the JIT limit."""
    inp = rule_inputs(features, rules)
    if keep:
        extra = features.select("customer_id", *keep)
    out = inp
    for typ in K.TYPOLOGIES:
        out = out.select("*", *typology_points(typ, rules))
        names = [indicator_column_name(typ, ind) for ind, _ in rules[typ]]
        out = out.withColumn(f"rule_{typ}", clip01_sum(names))
    point_cols = [indicator_column_name(t, i) for _, t, i in indicator_ids(rules)]
    out = out.select("customer_id", *[F.col(f"`{c}`") for c in point_cols],
                     *[f"rule_{t}" for t in K.TYPOLOGIES])
    if keep:
        out = out.join(extra, "customer_id")
    return out


def typology_rule_scores(features: DataFrame, typ: str, rules: dict[str, list[Indicator]] = RULES) -> DataFrame:
    """Single-typology view: customer_id, indicator points, clipped score."""
    inp = rule_inputs(features, rules)
    names = [indicator_column_name(typ, ind) for ind, _ in rules[typ]]
    out = inp.select("customer_id", *typology_points(typ, rules))
    return out.select("customer_id", *[F.col(f"`{n}`") for n in names], clip01_sum(names).alias(f"rule_{typ}"))


def with_rule_summary(points: DataFrame) -> DataFrame:
    """rule_score_weighted, rules_triggered (typologies with score > 0) and
    the raw-rule argmax typology."""
    from ..functions.columns import argmax_label, bool_int

    score_cols = [f"rule_{t}" for t in K.TYPOLOGIES]
    weighted = None
    for t in K.TYPOLOGIES:
        term = F.col(f"rule_{t}") * K.TYPOLOGY_WEIGHTS[t]
        weighted = term if weighted is None else weighted + term
    triggered = sum(bool_int(F.col(c) > 0) for c in score_cols)
    return (points.withColumn("rule_score_weighted", weighted)
                  .withColumn("rules_triggered", triggered.cast("int"))
                  .withColumn("primary_rule_typology",
                              argmax_label(score_cols, [K.TYPOLOGY_LABELS[t] for t in K.TYPOLOGIES])))
