"""Population-relative features: segment ratios, p99 normalisation, the five
typology composite scores, and final imputation.

Population statistics are one-row aggregates over the customer table. They
are computed with ``exact_quantiles`` (distributed, bounded driver traffic)
and enter the plan as literals, so the per-customer projection that uses them
is a single narrow stage.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.columns import bool_int, lit_d
from .quantiles import QSpec, exact_quantiles

SEGMENT_METRICS = ["total_outflow", "total_inflow", "total_volume",
                   "transactions_per_active_day", "flow_through_ratio"]
SEGMENTS = [("ind", "is_individual"), ("bus", "is_business")]

# FIXED VALUES: columns zero-filled before composites (a NULL would poison the sum).
COMPOSITE_INPUTS = [
    "spending_to_income_ratio", "volume_to_sales_ratio", "income_vol_ratio",
    "monthly_volume_cv", "amount_cv", "flow_through_ratio",
    "ratio_round_100", "transactions_per_active_day",
]

# FIXED VALUES: columns normalised by their population p99.
P99_COLUMNS = [
    "sum_wire", "count_abm", "sum_westernunion", "count_cheque", "count_eft", "count_emt",
    "count_card", "income_vol_ratio", "volume_to_sales_ratio", "spending_to_income_ratio",
    "count_near_10k", "transactions_per_active_day", "monthly_volume_cv", "amount_cv",
    "greylist_txn_count", "ht_source_country_txn_count", "night_abm_count", "card_luxury_sum",
    "card_accommodation_count", "card_adult_afterhours_count", "card_parking_count",
    "card_delivery_count", "card_travel_sum", "emt_debit_count", "eft_debit_count",
]

COMPOSITE_COLUMNS = [f"{t}_risk" for t in K.TYPOLOGIES] + ["overall_typology_max_risk", "typology_breadth"]


def _clip_hi(c: Column, hi) -> Column:
    """min(c, hi) that keeps NULL (``least`` would skip it)."""
    hi = hi if isinstance(hi, Column) else lit_d(hi)
    return F.when(c > hi, hi).otherwise(c)


def _clip01(c: Column) -> Column:
    return F.when(c < 0, lit_d(0.0)).when(c > 1, lit_d(1.0)).otherwise(c)


# ---------------------------------------------------------------------------
# Segment ratios
# ---------------------------------------------------------------------------

def segment_specs() -> list[QSpec]:
    return [QSpec(f"{m}|{seg}|{stat}", f"CASE WHEN `{flag}` = 1 THEN `{m}` END", p)
            for m in SEGMENT_METRICS for seg, flag in SEGMENTS for stat, p in (("median", 0.5), ("p90", 0.9))]


def segment_stats(f: DataFrame, q: dict[str, float | None] | None = None) -> dict[str, float]:
    """Median and p90 of each metric inside each segment; a segment with no
    member uses 1 for both. ``q``: the quantiles, where they are known."""
    specs = segment_specs()
    sizes = f.agg(*[F.sum(F.col(flag)).alias(seg) for seg, flag in SEGMENTS]).first()
    q = exact_quantiles(f, specs) if q is None else q
    return {s.name: 1.0 if (sizes[s.name.split("|")[1]] or 0) == 0 else q[s.name] for s in specs}


def with_segment_ratios(f: DataFrame, stats: dict[str, float]) -> DataFrame:
    cols = []
    for m in SEGMENT_METRICS:
        for seg, _ in SEGMENTS:
            med = stats[f"{m}|{seg}|median"]
            p90 = stats[f"{m}|{seg}|p90"]
            med_c = lit_d(med) if med is not None else F.lit(None).cast("double")
            p90_c = lit_d(p90) if p90 is not None else F.lit(None).cast("double")
            cols.append(F.try_divide(F.col(m), med_c + 1).alias(f"{m}_vs_{seg}_median"))
            cols.append(bool_int(F.col(m) > p90_c).alias(f"{m}_above_{seg}_p90"))
    return f.select("*", *cols)


SEGMENT_COLUMNS = [f"{m}_{kind}_{seg}_{stat}" for m in SEGMENT_METRICS for seg, _ in SEGMENTS
                   for kind, stat in (("vs", "median"), ("above", "p90"))]


def with_profile_ratios(f: DataFrame) -> DataFrame:
    return (f.withColumn("spending_to_income_ratio",
                         F.coalesce(F.try_divide(F.col("total_outflow"), F.col("income") + 1), lit_d(0.0)))
             .withColumn("volume_to_sales_ratio",
                         F.coalesce(F.try_divide(F.col("total_inflow") + F.col("total_outflow"), F.col("sales") + 1), lit_d(0.0)))
             .withColumn("income_vol_ratio",
                         F.coalesce(F.try_divide(F.col("total_volume"), F.col("income") + 1), lit_d(0.0))))


# ---------------------------------------------------------------------------
# Population p99 and composites
# ---------------------------------------------------------------------------

def population_p99(f: DataFrame, columns: list[str] = P99_COLUMNS) -> dict[str, float]:
    """p99 per column; NULL, NaN or <= 0 falls back to 1.0."""
    return _usable(exact_quantiles(f, [QSpec(c, f"`{c}`", 0.99) for c in columns]))


def _usable(p99: dict[str, float | None]) -> dict[str, float]:
    return {c: (v if (v is not None and v == v and v > 0) else 1.0) for c, v in p99.items()}


def with_composites(f: DataFrame, p99: dict[str, float]) -> DataFrame:
    def N(c: str) -> Column:          # clip01(min(c, p99) / p99)
        return _clip01(_clip_hi(F.col(c), p99[c]) / lit_d(p99[c]))

    def N1(c: str) -> Column:         # min(c, p99) / (p99 + 1), no clip
        return _clip_hi(F.col(c), p99[c]) / lit_d(p99[c] + 1.0)

    def c01(c: str | Column) -> Column:
        return _clip01(F.col(c) if isinstance(c, str) else c)

    cities = _clip_hi(F.col("unique_cities").cast("double"), 20.0) / lit_d(20.0)
    tpad_norm = _clip_hi(F.col("transactions_per_active_day"), p99["transactions_per_active_day"]) / \
        lit_d(p99["transactions_per_active_day"])

    # FIXED VALUES: the weights of the five sums
    struct = (N("count_near_10k") * 0.25 + c01("flow_through_ratio") * 0.25 +
              c01("ratio_round_100") * 0.15 + cities * 0.10 + tpad_norm * 0.10 +
              c01(N("count_eft") + N("count_emt")) * 0.10 + N("sum_wire") * 0.05)
    behav = (N("spending_to_income_ratio") * 0.30 + N("income_vol_ratio") * 0.20 +
             N("monthly_volume_cv") * 0.20 + N("amount_cv") * 0.15 +
             N("volume_to_sales_ratio") * F.col("is_business") * 0.10 +
             F.col("channel_diversity") * 0.05)
    trade = (F.col("industry_risk_high").cast("double") * 0.25 + N("volume_to_sales_ratio") * 0.25 +
             c01("flow_through_ratio") * 0.20 + N("count_eft") * 0.15 +
             c01("ratio_round_1000") * 0.10 + N("count_abm") * 0.05)
    geo = (bool_int(F.col("high_risk_fatf_txn_count") > 0).cast("double") * 0.35 +
           c01("international_ratio") * 0.20 + N("sum_westernunion") * 0.15 +
           bool_int(F.col("drug_country_txn_count") > 0).cast("double") * 0.10 +
           N1("greylist_txn_count") * 0.10 + N("sum_wire") * 0.10)
    ht = (N("card_adult_afterhours_count") * 0.20 + c01("night_transaction_ratio") * 0.10 +
          c01(cities) * 0.15 + N("card_luxury_sum") * 0.10 + N("card_accommodation_count") * 0.10 +
          c01(N1("ht_source_country_txn_count")) * 0.10 + N("card_travel_sum") * 0.05 +
          c01(N("card_parking_count") + N("card_delivery_count")) * 0.05 +
          c01(N("emt_debit_count") + N("eft_debit_count")) * 0.10 +
          c01(N1("night_abm_count")) * 0.05)
    out = f.select("*",
                   _clip01(struct).alias("structuring_layering_risk"),
                   _clip01(behav).alias("behavioural_profile_risk"),
                   _clip01(trade).alias("trade_shell_risk"),
                   _clip01(geo).alias("cross_border_geo_risk"),
                   _clip01(ht).alias("human_trafficking_risk"))
    risk = [F.col(f"{t}_risk") for t in K.TYPOLOGIES]
    breadth = sum(bool_int(r > K.COMPOSITE_BREADTH_CUTOFF) for r in risk)
    return (out.withColumn("overall_typology_max_risk", F.greatest(*risk))
               .withColumn("typology_breadth", breadth.cast("int")))


# ---------------------------------------------------------------------------
# Imputation
# ---------------------------------------------------------------------------

# Double features that can be NULL by construction (no KYC row, no
# transaction with an amount, 0/0 ratios). They take the population median.
MEDIAN_IMPUTED = [
    "avg_transaction_amount", "median_transaction_amount", "min_transaction_amount",
    "max_transaction_amount", "inflow_outflow_ratio", "transactions_per_day", "volume_per_day",
    "inflow_per_day", "outflow_per_day", "ratio_below_10k", "ratio_round_1000",
    "avg_txn_per_city", "avg_txn_per_province", "international_ratio",
    "night_transaction_ratio", "evening_transaction_ratio", "weekend_ratio",
    "income", "occupation_code", "sales", "industry_code", "employee_count", "age",
    "customer_tenure_days",
]
# Whole-day features: the median in whole days (all timestamps of a customer
# may be unreadable).
DAY_IMPUTED = ["time_span_days"]


def impute_medians(f: DataFrame, columns: list[str] | None = None) -> dict[str, float | None]:
    columns = MEDIAN_IMPUTED + DAY_IMPUTED if columns is None else columns
    return exact_quantiles(f, [QSpec(c, f"`{c}`", 0.5) for c in columns])


def population_stats(f: DataFrame) -> tuple[dict[str, float], dict[str, float], dict[str, float | None]]:
    """``segment_stats``, ``population_p99`` and ``impute_medians`` of the
    customers with their profile ratios, in the same jobs. The last two see the
    composites' inputs with NULL as 0, as the later steps do."""
    def value(c: str) -> str:
        return f"coalesce(CAST(`{c}` AS DOUBLE), 0D)" if c in COMPOSITE_INPUTS else f"`{c}`"

    p99 = [QSpec(f"p99|{c}", value(c), 0.99) for c in P99_COLUMNS]
    medians = [QSpec(f"median|{c}", value(c), 0.5) for c in MEDIAN_IMPUTED + DAY_IMPUTED]
    q = exact_quantiles(f, segment_specs() + p99 + medians)
    return (segment_stats(f, q), _usable({c: q[f"p99|{c}"] for c in P99_COLUMNS}),
            {c: q[f"median|{c}"] for c in MEDIAN_IMPUTED + DAY_IMPUTED})


def with_imputation(f: DataFrame, medians: dict[str, float | None]) -> DataFrame:
    repl = {}
    for c, m in medians.items():
        if c in DAY_IMPUTED:
            fill = F.lit(None if m is None else math.floor(m + 0.5)).cast("long")
        else:
            fill = lit_d(m) if m is not None else F.lit(None).cast("double")
        repl[c] = F.coalesce(F.col(c), fill).alias(c)
    return f.select(*[repl.get(c, F.col(c)) for c in f.columns])
