"""Result presentation shared by ``queries()`` and the oracle SQL.

Both sides emit: integers as BIGINT; doubles rounded half-up to 4 decimals
(amounts and their sums) or 8 (scores, ratios and other values around 1), after
rounding to 2 more (values on an exact midpoint, such as a median of two
amounts, would otherwise round apart on last-bit differences, as summation
order differs between engines); dates as 'yyyy-MM-dd' text, timestamps as
'yyyy-MM-dd HH:mm:ss' text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 4
FINE_DIGITS = 8
FINE_PARTS = ("score", "ratio", "risk", "norm", "coverage", "auc", "correlation", "hhi", "_cv", "diversity",
              "silhouette", "dynamic_", "rule_", "per_city", "per_province")


def digits_of(name: str) -> int:
    return FINE_DIGITS if any(part in name for part in FINE_PARTS) else DIGITS


INT_NAMES = {
    "transaction_count_total", "transaction_count_debit", "transaction_count_credit", "active_days",
    "time_span_days", "max_days_between_txns", "typology_breadth", "label", "occupation_risk_high",
    "industry_risk_high", "ht_accommodation_sector", "rules_triggered", "n", "n_rows", "n_customers",
    "cluster", "rank", "batch_id", "predicted_label", "actual_label", "hour", "day_of_week",
    "ecommerce_ind", "cash_indicator", "customer_id", "positives", "pos", "position", "first_rank",
    "last_rank", "k", "overlap", "top_n", "cutoff", "captured", "cluster_size", "code", "risk_high",
    "null_count", "strict_ok", "header_ok", "malformed_rows", "unknown_ids", "missing_ids", "passed",
    "is_best", "tree", "node", "card_unique_cities", "card_unique_countries",
}
FLOAT_NAMES = {"employee_count"}
INT_PREFIXES = ("count_", "rows_", "has_", "is_", "unique_", "n_")
INT_SUFFIXES = ("_count", "_p90", "_flag", "_rank", "_n")
STR_NAMES = {"customer_type", "established_date", "channel", "debit_credit", "country", "province",
             "city", "merchant_category", "year_month", "typology", "feature", "primary_typology",
             "risk_category", "primary_rule_typology", "rule_indicator_trace", "hybrid_risk_category",
             "cluster_primary_typology", "label_text", "metric", "item", "kind", "score",
             "indicator_id", "explanation", "status", "narrative", "customer_ids"}
DATE_NAMES = {"birth_date", "onboard_date", "date"}
TS_NAMES = {"first_transaction_date", "last_transaction_date", "transaction_datetime"}


def kind_of(name: str) -> str:
    if name in FLOAT_NAMES:
        return "d"
    if name in STR_NAMES:
        return "s"
    if name in DATE_NAMES:
        return "date"
    if name in TS_NAMES:
        return "ts"
    if name in INT_NAMES or name.startswith(INT_PREFIXES) or name.endswith(INT_SUFFIXES):
        return "i"
    return "d"


def present(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        digits = digits_of(f.name)
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.DoubleType, T.FloatType, T.DecimalType)):
            # two-stage: collapse last-bit differences first, then round half-up
            c = F.round(F.round(c.cast("double"), digits + 2), digits)
        elif isinstance(t, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        elif isinstance(t, T.BooleanType):
            c = c.cast("long")
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def sql_col(name: str, kind: str | None = None, src: str | None = None) -> str:
    kind = kind or kind_of(name)
    digits = digits_of(name)
    x = src or f'"{name}"'
    if kind == "i":
        e = f"CAST({x} AS BIGINT)"
    elif kind == "d":
        e = f"CAST(round(CAST({x} AS DECIMAL(38,{digits + 2})), {digits}) AS DOUBLE)"
    elif kind == "date":
        e = f"strftime({x}, '%Y-%m-%d')"
    elif kind == "ts":
        e = f"strftime({x}, '%Y-%m-%d %H:%M:%S')"
    else:
        e = f"CAST({x} AS VARCHAR)"
    return f'{e} AS "{name}"'


def sql_select(names: list[str], source: str, kinds: dict[str, str] | None = None,
               where: str = "") -> str:
    kinds = kinds or {}
    cols = ",\n  ".join(sql_col(n, kinds.get(n)) for n in names)
    w = f"\nWHERE {where}" if where else ""
    return f"SELECT\n  {cols}\nFROM {source}{w}"
