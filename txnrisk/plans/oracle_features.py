"""DuckDB SQL for the transaction fixture and the customer feature table.

Written independently of the Spark operators (plain SQL over the driver's
views ``lineitem orders customer``), so that the comparison checks the Spark
plan against a second engine. Every statement is a CTE list; other oracle
modules extend it.
"""

from __future__ import annotations

from .. import constants as K


def d(x: float) -> str:
    """Double literal (a bare 0.25 is DECIMAL in DuckDB)."""
    return f"CAST({float(x)!r} AS DOUBLE)"


def sql_list(vals) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in vals)


def _case(expr: str, mapping, default="NULL") -> str:
    whens = " ".join(f"WHEN {k} THEN {v}" for k, v in mapping)
    return f"CASE {expr} {whens} ELSE {default} END"


CHANNEL_BY_SUPP = _case("l_suppkey % 7", [(i, f"'{c}'") for i, c in enumerate(K.CHANNELS)])
MCC_BY_QTY = _case("CAST(trunc(l_quantity) AS BIGINT) % 10",
                   [(0, "'5411'"), (1, "'5944'"), (2, "'7523'"), (3, "'5814'"), (4, "'4816'"),
                    (5, "'7011'"), (6, "'3005'"), (7, "'7297'")], "'5541'")
COUNTRY_BY_PART = _case("l_partkey % 25", [(3, "'IR'"), (4, "'MX'"), (8, "'CN'"), (9, "'KY'"), (13, "'PA'")],
                        "'US'")

TXN_CTES = f"""
txn_j AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity,
         l.l_extendedprice, l.l_linestatus,
         CAST(floor(o.o_custkey / 10) AS BIGINT) AS customer_id
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
txn_k AS (
  SELECT *, customer_id % 6 AS prof, l_orderkey * 7 + l_linenumber * 3 + l_partkey AS k FROM txn_j
),
txn_c AS (
  SELECT *,
    CASE WHEN prof = 5 AND k % 3 < 2 THEN 'Wire' ELSE {CHANNEL_BY_SUPP} END AS channel,
    CASE WHEN prof = 1 THEN k % 12
         WHEN prof = 2 THEN k % 20 + CASE WHEN k % 2 = 0 THEN 220 ELSE 0 END
         ELSE k % 300 END AS day_off,
    CASE WHEN prof = 3 AND k % 4 < 3 THEN 23 ELSE (k * 5) % 24 END AS hr
  FROM txn_k
),
txn_raw AS (
  SELECT customer_id,
    CASE WHEN k % 11 = 0 OR (prof = 4 AND k % 10 < 8) THEN floor(l_extendedprice / 4000) * {d(1000)}
         WHEN k % 7 = 0 THEN floor(l_extendedprice / 400) * {d(100)}
         ELSE l_extendedprice / CASE channel WHEN 'ABM' THEN {d(10)} WHEN 'Card' THEN {d(100)} ELSE {d(4)} END
    END AS amount_cad,
    CASE WHEN l_linestatus = 'F' THEN 'D' ELSE 'C' END AS debit_credit,
    TIMESTAMP '2024-01-01' + to_days(CAST(day_off AS INTEGER)) + to_hours(CAST(hr AS INTEGER))
      + to_minutes(CAST(l_partkey % 60 AS INTEGER)) AS transaction_datetime,
    CASE WHEN channel <> 'Card' THEN NULL WHEN l_partkey % 5 < 3 THEN 'CA' ELSE {COUNTRY_BY_PART} END AS country,
    'prov' || CAST(l_partkey % (1 + prof % 3) AS VARCHAR) AS province,
    'city' || CAST(l_partkey % (1 + prof * 2) AS VARCHAR) AS city,
    CASE WHEN channel = 'Card' THEN {MCC_BY_QTY} END AS merchant_category,
    CASE WHEN channel = 'Card' THEN CASE WHEN l_partkey % 3 = 0 THEN 1 ELSE 0 END END AS ecommerce_ind,
    CASE WHEN channel = 'ABM' THEN CAST(l_partkey % 2 AS INTEGER) END AS cash_indicator,
    channel
  FROM txn_c
),
txn AS (
  SELECT *,
    hour(transaction_datetime) AS hour,
    isodow(transaction_datetime) - 1 AS day_of_week,
    coalesce(strftime(transaction_datetime, '%Y-%m'), 'NaT') AS year_month,
    CAST(transaction_datetime AS DATE) AS date,
    split_part(trim(CAST(merchant_category AS VARCHAR)), '.', 1) AS mcc
  FROM txn_raw WHERE customer_id IS NOT NULL
)"""

KYC_CTES = f"""
kyc_base AS (
  SELECT CAST(floor(c_custkey / 10) AS BIGINT) AS customer_id, max(c_acctbal) AS c_acctbal FROM customer GROUP BY 1
),
kyc_ind AS (
  SELECT customer_id,
    ({d(20000)} + abs(c_acctbal) * 10) * (1 + (customer_id % 10) * 10) AS income,
    {_case('customer_id % 5', [(0, 41101), (1, 63101), (2, 12345), (3, 70010)])} AS occupation_code,
    DATE '1950-01-01' + CAST((customer_id * 37) % 18000 AS INTEGER) AS birth_date,
    DATE '2023-01-01' + CAST((customer_id * 11) % 700 AS INTEGER) AS onboard_date
  FROM kyc_base WHERE customer_id % 4 < 3
),
kyc_bus AS (
  SELECT customer_id,
    ({d(50000)} + abs(c_acctbal) * 100) * (1 + (customer_id % 5) * 4) AS sales,
    {_case('customer_id % 5', [(0, 6561), (1, 9111), (2, 1000), (3, 7611), (4, 2000)])} AS industry_code,
    CAST(customer_id % 15 AS DOUBLE) AS employee_count,
    strftime(DATE '2000-01-01' + CAST((customer_id * 53) % 7000 AS INTEGER), '%Y-%m-%d') AS established_date
  FROM kyc_base WHERE customer_id % 4 = 3
),
kyc_ind_t AS (
  SELECT *, CASE WHEN occupation_code IN ({sql_list(K.HIGH_RISK_OCCUPATION_CODES)}) THEN 1 ELSE 0 END
            AS occupation_risk_high FROM kyc_ind
),
kyc_bus_t AS (
  SELECT *, CASE WHEN industry_code IN ({sql_list(K.HIGH_RISK_INDUSTRY_CODES)}) THEN 1 ELSE 0 END AS industry_risk_high,
            CASE WHEN industry_code IN ({sql_list(K.HT_ACCOMMODATION_INDUSTRY_CODES)}) THEN 1 ELSE 0 END
            AS ht_accommodation_sector FROM kyc_bus
),
cust_labels AS (
  SELECT customer_id,
    CASE WHEN customer_id % 6 IN (1, 3, 4) AND customer_id % 5 = 0 THEN 1
         WHEN customer_id % 3 = 0 THEN 0 END AS label
  FROM kyc_base
),
labels_known AS (SELECT customer_id, label FROM cust_labels WHERE label IS NOT NULL)"""


def _ch_aggs() -> str:
    out = []
    for ch in K.CHANNELS:
        lo = ch.lower()
        out += [
            f"count(amount_cad) FILTER (WHERE channel = '{ch}') AS count_{lo}",
            f"coalesce(sum(amount_cad) FILTER (WHERE channel = '{ch}'), 0.0) AS sum_{lo}",
            f"coalesce(avg(amount_cad) FILTER (WHERE channel = '{ch}'), 0.0) AS mean_{lo}",
            f"count(*) FILTER (WHERE channel = '{ch}') AS rows_{lo}",
        ]
    return ",\n    ".join(out)


NIGHT = "(hour >= 22 OR hour <= 5)"
CARD = "channel = 'Card'"


def _mcc_in(codes) -> str:
    return f"mcc IN ({sql_list(codes)})"


TRAVEL = f"({_mcc_in(K.MCC_TRAVEL)} OR regexp_full_match(mcc, '3[0-2][0-9][0-9]'))"


def _cnt(cond: str) -> str:
    return f"count(amount_cad) FILTER (WHERE {cond})"


def _rows(cond: str) -> str:
    return f"count(*) FILTER (WHERE {cond})"


def _sum(cond: str) -> str:
    return f"coalesce(sum(amount_cad) FILTER (WHERE {cond}), 0.0)"


INTL = "country IS DISTINCT FROM 'CA'"

WIDE_CTE = f"""
w AS (
  SELECT customer_id,
    count(amount_cad) AS transaction_count_total,
    coalesce(sum(amount_cad), 0.0) AS total_volume,
    avg(amount_cad) AS avg_transaction_amount,
    quantile_cont(amount_cad, 0.5) AS median_transaction_amount,
    stddev_samp(amount_cad) AS std_raw,
    min(amount_cad) AS min_transaction_amount,
    max(amount_cad) AS max_transaction_amount,
    min(transaction_datetime) AS first_transaction_date,
    max(transaction_datetime) AS last_transaction_date,
    {_cnt("debit_credit = 'D'")} AS transaction_count_debit,
    {_sum("debit_credit = 'D'")} AS total_outflow,
    {_cnt("debit_credit = 'C'")} AS transaction_count_credit,
    {_sum("debit_credit = 'C'")} AS total_inflow,
    {_rows("amount_cad >= 9000 AND amount_cad < 10000")} AS count_near_10k,
    {_rows("amount_cad >= 9800 AND amount_cad < 10000")} AS count_very_near_10k,
    {_cnt("amount_cad < 10000")} AS count_below_10k,
    {_sum("amount_cad < 10000")} AS sum_below_10k,
    {_rows("amount_cad % 100 = 0")} AS count_round_100,
    {_rows("amount_cad % 1000 = 0")} AS count_round_1000,
    {_rows("channel = 'ABM' AND cash_indicator = 1 AND amount_cad < 10000")} AS cash_struct_count,
    {_ch_aggs()},
    count(*) AS rows_total,
    {_cnt(f"{CARD} AND {_mcc_in(K.MCC_RETAIL)}")} AS card_retail_count,
    {_sum(f"{CARD} AND {_mcc_in(K.MCC_RETAIL)}")} AS card_retail_sum,
    {_cnt(f"{CARD} AND {_mcc_in(K.MCC_LUXURY)}")} AS card_luxury_count,
    {_sum(f"{CARD} AND {_mcc_in(K.MCC_LUXURY)}")} AS card_luxury_sum,
    {_cnt(f"{CARD} AND {_mcc_in(K.MCC_PARKING)}")} AS card_parking_count,
    {_cnt(f"{CARD} AND {_mcc_in(K.MCC_FOOD_DELIVERY)}")} AS card_delivery_count,
    {_cnt(f"{CARD} AND {_mcc_in(K.MCC_DIGITAL)}")} AS card_digital_count,
    {_sum(f"{CARD} AND {_mcc_in(K.MCC_DIGITAL)}")} AS card_digital_sum,
    {_cnt(f"{CARD} AND {_mcc_in(K.MCC_ACCOMMODATION)}")} AS card_accommodation_count,
    {_sum(f"{CARD} AND {_mcc_in(K.MCC_ACCOMMODATION)}")} AS card_accommodation_sum,
    {_cnt(f"{CARD} AND {TRAVEL}")} AS card_travel_count,
    {_sum(f"{CARD} AND {TRAVEL}")} AS card_travel_sum,
    {_rows(f"{CARD} AND {_mcc_in(K.MCC_ADULT_SPA)} AND {NIGHT}")} AS card_adult_afterhours_count,
    {_rows(f"{CARD} AND {NIGHT}")} AS card_afterhours_count,
    {_cnt(f"{CARD} AND ecommerce_ind = 1")} AS card_ecommerce_count,
    {_sum(f"{CARD} AND ecommerce_ind = 1")} AS card_ecommerce_sum,
    {_cnt("channel = 'EFT' AND debit_credit = 'C'")} AS eft_credit_count,
    {_sum("channel = 'EFT' AND debit_credit = 'C'")} AS eft_credit_sum,
    {_cnt("channel = 'EFT' AND debit_credit = 'D'")} AS eft_debit_count,
    {_sum("channel = 'EFT' AND debit_credit = 'D'")} AS eft_debit_sum,
    {_cnt("channel = 'EMT' AND debit_credit = 'C'")} AS emt_credit_count,
    {_sum("channel = 'EMT' AND debit_credit = 'C'")} AS emt_credit_sum,
    {_cnt("channel = 'EMT' AND debit_credit = 'D'")} AS emt_debit_count,
    {_sum("channel = 'EMT' AND debit_credit = 'D'")} AS emt_debit_sum,
    {_cnt(INTL)} AS international_txn_count,
    {_sum(INTL)} AS international_txn_sum,
    {", ".join(f"{_rows(f'country IN ({sql_list(cs)})')} AS {name}" for name, cs in K.GEO_RISK_SETS)},
    {_rows(NIGHT)} AS night_transaction_count,
    {_rows("hour >= 18 AND hour <= 21")} AS evening_transaction_count,
    {_rows("day_of_week IN (5, 6)")} AS weekend_transaction_count,
    {_rows(f"channel = 'ABM' AND {NIGHT}")} AS night_abm_count
  FROM txn GROUP BY customer_id
),
dc AS (
  SELECT customer_id,
    count(DISTINCT country) AS unique_countries,
    count(DISTINCT province) AS unique_provinces,
    count(DISTINCT city) AS unique_cities,
    count(DISTINCT CASE WHEN {CARD} THEN city END) AS card_unique_cities,
    count(DISTINCT CASE WHEN {CARD} THEN country END) AS card_unique_countries
  FROM txn GROUP BY customer_id
),
txn_gap AS (
  SELECT customer_id, transaction_datetime AS ts,
         lag(transaction_datetime) OVER (PARTITION BY customer_id ORDER BY transaction_datetime) AS prev_ts
  FROM txn WHERE transaction_datetime IS NOT NULL
),
gap AS (
  SELECT customer_id,
    coalesce(max(CAST(floor((epoch_us(ts) - epoch_us(prev_ts)) / 86400000000.0) AS BIGINT)), 0) AS max_days_between_txns
  FROM txn_gap GROUP BY customer_id
),
act AS (
  SELECT customer_id, count(DISTINCT date) AS active_days FROM txn GROUP BY customer_id
),
mth0 AS (
  SELECT customer_id, year_month, count(amount_cad) AS c, coalesce(sum(amount_cad), 0.0) AS v
  FROM txn GROUP BY customer_id, year_month
),
mth AS (
  SELECT customer_id,
    coalesce(stddev_samp(c), 0.0) AS monthly_txn_count_std,
    avg(c) AS monthly_txn_count_mean,
    coalesce(stddev_samp(v), 0.0) AS monthly_volume_std,
    avg(v) AS monthly_volume_mean,
    coalesce(stddev_samp(c) / (avg(c) + 1), 0.0) AS monthly_txn_cv,
    coalesce(stddev_samp(v) / (avg(v) + 1), 0.0) AS monthly_volume_cv
  FROM mth0 GROUP BY customer_id
),
card_last AS (
  SELECT customer_id, max(transaction_datetime) AS last_card FROM txn WHERE {CARD} GROUP BY customer_id
),
rec AS (
  SELECT t.customer_id,
    coalesce(sum(t.amount_cad) FILTER (WHERE floor((epoch_us(c.last_card) - epoch_us(t.transaction_datetime)) / 86400000000.0) <= 30), 0.0) AS card_volume_30d,
    coalesce(sum(t.amount_cad) FILTER (WHERE floor((epoch_us(c.last_card) - epoch_us(t.transaction_datetime)) / 86400000000.0) <= 90), 0.0) AS card_volume_90d
  FROM txn t JOIN card_last c ON t.customer_id = c.customer_id
  WHERE t.channel = 'Card' GROUP BY t.customer_id
)"""


def _div(a: str, b: str) -> str:
    return f"(({a}) / nullif(({b}), 0))"


_HHI = " + ".join(f"pow(rows_{c.lower()} / CAST(rows_total AS DOUBLE), 2)" for c in K.CHANNELS)
_UNIQ_CH = " + ".join(f"CASE WHEN rows_{c.lower()} > 0 THEN 1 ELSE 0 END" for c in K.CHANNELS)

BEH_CTE = f"""
b0 AS (
  SELECT w.*, dc.unique_countries, dc.unique_provinces, dc.unique_cities,
    coalesce(dc.card_unique_cities, 0) AS card_unique_cities,
    coalesce(dc.card_unique_countries, 0) AS card_unique_countries,
    coalesce(act.active_days, 0) AS active_days,
    coalesce(gap.max_days_between_txns, 0) AS max_days_between_txns,
    mth.monthly_txn_count_std, mth.monthly_txn_count_mean, mth.monthly_volume_std,
    mth.monthly_volume_mean, mth.monthly_txn_cv, mth.monthly_volume_cv,
    coalesce(rec.card_volume_30d, 0.0) AS card_volume_30d,
    coalesce(rec.card_volume_90d, 0.0) AS card_volume_90d,
    coalesce(w.std_raw, 0.0) AS std_transaction_amount,
    CAST(floor((epoch_us(w.last_transaction_date) - epoch_us(w.first_transaction_date)) / 86400000000.0) AS BIGINT) + 1
      AS time_span_days
  FROM w
  LEFT JOIN dc ON w.customer_id = dc.customer_id
  LEFT JOIN act ON w.customer_id = act.customer_id
  LEFT JOIN gap ON w.customer_id = gap.customer_id
  LEFT JOIN mth ON w.customer_id = mth.customer_id
  LEFT JOIN rec ON w.customer_id = rec.customer_id
),
beh AS (
  SELECT *,
    total_inflow - total_outflow AS net_flow,
    {_div("total_inflow", "total_outflow + 1")} AS inflow_outflow_ratio,
    {_div("std_transaction_amount", "avg_transaction_amount + 1")} AS amount_cv,
    {_div("transaction_count_total", "time_span_days")} AS transactions_per_day,
    {_div("transaction_count_total", "greatest(active_days, 1)")} AS transactions_per_active_day,
    {_div("total_volume", "time_span_days")} AS volume_per_day,
    {_div("total_inflow", "time_span_days")} AS inflow_per_day,
    {_div("total_outflow", "time_span_days")} AS outflow_per_day,
    {_div("least(total_inflow, total_outflow)", "total_volume / 2 + 1")} AS flow_through_ratio,
    {_div("count_below_10k", "transaction_count_total")} AS ratio_below_10k,
    {_div("count_round_100", "transaction_count_total")} AS ratio_round_100,
    {_div("count_round_1000", "transaction_count_total")} AS ratio_round_1000,
    CAST({_UNIQ_CH} AS BIGINT) AS unique_channels,
    ({_UNIQ_CH}) / {d(len(K.CHANNELS))} AS channel_diversity,
    {_HHI} AS channel_concentration_hhi,
    CASE WHEN count_westernunion > 0 THEN 1 ELSE 0 END AS has_western_union,
    CASE WHEN count_wire > 0 THEN 1 ELSE 0 END AS has_wire,
    CASE WHEN count_eft > 0 THEN 1 ELSE 0 END AS has_eft,
    CASE WHEN count_emt > 0 THEN 1 ELSE 0 END AS has_emt,
    coalesce({_div("card_volume_30d", "sum_card + 1")}, 0.0) AS card_30d_ratio,
    coalesce({_div("card_volume_90d", "sum_card + 1")}, 0.0) AS card_90d_ratio,
    {_div("transaction_count_total", "unique_cities + 0.1")} AS avg_txn_per_city,
    {_div("transaction_count_total", "unique_provinces + 0.1")} AS avg_txn_per_province,
    {_div("international_txn_count", "transaction_count_total")} AS international_ratio,
    CASE WHEN drug_country_txn_count > 0 OR high_risk_fatf_txn_count > 0 OR offshore_center_txn_count > 0
         THEN 1 ELSE 0 END AS has_any_high_risk_txn,
    {_div("night_transaction_count", "transaction_count_total")} AS night_transaction_ratio,
    {_div("evening_transaction_count", "transaction_count_total")} AS evening_transaction_ratio,
    {_div("weekend_transaction_count", "transaction_count_total")} AS weekend_ratio
  FROM b0
)"""

AS_OF = "DATE '2024-12-31'"

KYCF_CTE = f"""
kf AS (
  SELECT beh.*, i.income, CAST(i.occupation_code AS DOUBLE) AS occupation_code, i.birth_date, i.onboard_date,
    coalesce(i.occupation_risk_high, 0) AS occupation_risk_high,
    s.sales, CAST(s.industry_code AS DOUBLE) AS industry_code, s.employee_count, s.established_date,
    coalesce(s.industry_risk_high, 0) AS industry_risk_high,
    coalesce(s.ht_accommodation_sector, 0) AS ht_accommodation_sector,
    CASE WHEN s.sales IS NOT NULL THEN 'business' WHEN i.income IS NOT NULL THEN 'individual'
         ELSE 'unknown' END AS customer_type,
    CASE WHEN s.sales IS NOT NULL THEN 1 ELSE 0 END AS is_business,
    CASE WHEN s.sales IS NULL AND i.income IS NOT NULL THEN 1 ELSE 0 END AS is_individual,
    date_diff('day', i.birth_date, {AS_OF}) / {d(365.25)} AS age,
    CAST(date_diff('day', i.onboard_date, {AS_OF}) AS DOUBLE) AS customer_tenure_days
  FROM beh
  LEFT JOIN kyc_ind_t i ON beh.customer_id = i.customer_id
  LEFT JOIN kyc_bus_t s ON beh.customer_id = s.customer_id
)"""

SEG_METRICS = ["total_outflow", "total_inflow", "total_volume", "transactions_per_active_day", "flow_through_ratio"]
SEGS = [("ind", "is_individual"), ("bus", "is_business")]


def _seg_stats() -> str:
    cols = []
    for m in SEG_METRICS:
        for seg, flag in SEGS:
            for stat, p in (("median", 0.5), ("p90", 0.9)):
                cols.append(
                    f"CASE WHEN count(*) FILTER (WHERE {flag} = 1) = 0 THEN 1.0 "
                    f"ELSE quantile_cont({m}, {p}) FILTER (WHERE {flag} = 1) END AS {m}__{seg}__{stat}")
    return ",\n    ".join(cols)


def _seg_cols() -> str:
    cols = []
    for m in SEG_METRICS:
        for seg, _ in SEGS:
            cols.append(f"{_div(f'kf.{m}', f'ss.{m}__{seg}__median + 1')} AS {m}_vs_{seg}_median")
            cols.append(f"CASE WHEN kf.{m} > ss.{m}__{seg}__p90 THEN 1 ELSE 0 END AS {m}_above_{seg}_p90")
    return ",\n    ".join(cols)


COMPOSITE_INPUTS = ["spending_to_income_ratio", "volume_to_sales_ratio", "income_vol_ratio",
                    "monthly_volume_cv", "amount_cv", "flow_through_ratio", "ratio_round_100",
                    "transactions_per_active_day"]
P99_COLS = [
    "sum_wire", "count_abm", "sum_westernunion", "count_cheque", "count_eft", "count_emt",
    "count_card", "income_vol_ratio", "volume_to_sales_ratio", "spending_to_income_ratio",
    "count_near_10k", "transactions_per_active_day", "monthly_volume_cv", "amount_cv",
    "greylist_txn_count", "ht_source_country_txn_count", "night_abm_count", "card_luxury_sum",
    "card_accommodation_count", "card_adult_afterhours_count", "card_parking_count",
    "card_delivery_count", "card_travel_sum", "emt_debit_count", "eft_debit_count",
]

SEG_CTE = f"""
ss AS (
  SELECT {_seg_stats()} FROM kf
),
sr AS (
  SELECT kf.*, {_seg_cols()},
    coalesce({_div("kf.total_outflow", "kf.income + 1")}, 0.0) AS spending_to_income_ratio_raw,
    coalesce({_div("kf.total_inflow + kf.total_outflow", "kf.sales + 1")}, 0.0) AS volume_to_sales_ratio_raw,
    coalesce({_div("kf.total_volume", "kf.income + 1")}, 0.0) AS income_vol_ratio_raw
  FROM kf CROSS JOIN ss
),
zf AS (
  SELECT * EXCLUDE (amount_cv, monthly_volume_cv, flow_through_ratio, ratio_round_100, transactions_per_active_day,
                    spending_to_income_ratio_raw, volume_to_sales_ratio_raw, income_vol_ratio_raw),
    coalesce(spending_to_income_ratio_raw, 0.0) AS spending_to_income_ratio,
    coalesce(volume_to_sales_ratio_raw, 0.0) AS volume_to_sales_ratio,
    coalesce(income_vol_ratio_raw, 0.0) AS income_vol_ratio,
    coalesce(monthly_volume_cv, 0.0) AS monthly_volume_cv,
    coalesce(amount_cv, 0.0) AS amount_cv,
    coalesce(flow_through_ratio, 0.0) AS flow_through_ratio,
    coalesce(ratio_round_100, 0.0) AS ratio_round_100,
    coalesce(transactions_per_active_day, 0.0) AS transactions_per_active_day
  FROM sr
),
p99raw AS (
  SELECT {", ".join(f"quantile_cont({c}, 0.99) AS {c}" for c in P99_COLS)} FROM zf
),
p99 AS (
  SELECT {", ".join(f"CASE WHEN {c} IS NULL OR isnan({c}) OR {c} <= 0 THEN 1.0 ELSE {c} END AS {c}" for c in P99_COLS)}
  FROM p99raw
)"""


def _clip_hi(x: str, hi: str) -> str:
    return f"(CASE WHEN ({x}) > ({hi}) THEN ({hi}) ELSE ({x}) END)"


def _clip01(x: str) -> str:
    return f"(CASE WHEN ({x}) < 0 THEN 0.0 WHEN ({x}) > 1 THEN 1.0 ELSE ({x}) END)"


def _N(c: str) -> str:
    return _clip01(f"{_clip_hi('zf.' + c, 'p99.' + c)} / p99.{c}")


def _N1(c: str) -> str:
    return f"({_clip_hi('zf.' + c, 'p99.' + c)} / (p99.{c} + 1.0))"


def _c01(x: str) -> str:
    return _clip01(x)


_CITIES = f"({_clip_hi('CAST(zf.unique_cities AS DOUBLE)', d(20.0))} / {d(20.0)})"
_TPAD = f"({_clip_hi('zf.transactions_per_active_day', 'p99.transactions_per_active_day')} / p99.transactions_per_active_day)"

STRUCT_SQL = (f"{_N('count_near_10k')} * {d(0.25)} + {_c01('zf.flow_through_ratio')} * {d(0.25)} + "
              f"{_c01('zf.ratio_round_100')} * {d(0.15)} + {_CITIES} * {d(0.10)} + {_TPAD} * {d(0.10)} + "
              f"{_c01(_N('count_eft') + ' + ' + _N('count_emt'))} * {d(0.10)} + {_N('sum_wire')} * {d(0.05)}")
BEHAV_SQL = (f"{_N('spending_to_income_ratio')} * {d(0.30)} + {_N('income_vol_ratio')} * {d(0.20)} + "
             f"{_N('monthly_volume_cv')} * {d(0.20)} + {_N('amount_cv')} * {d(0.15)} + "
             f"{_N('volume_to_sales_ratio')} * zf.is_business * {d(0.10)} + zf.channel_diversity * {d(0.05)}")
TRADE_SQL = (f"CAST(zf.industry_risk_high AS DOUBLE) * {d(0.25)} + {_N('volume_to_sales_ratio')} * {d(0.25)} + "
             f"{_c01('zf.flow_through_ratio')} * {d(0.20)} + {_N('count_eft')} * {d(0.15)} + "
             f"{_c01('zf.ratio_round_1000')} * {d(0.10)} + {_N('count_abm')} * {d(0.05)}")
GEO_SQL = (f"CAST(CASE WHEN zf.high_risk_fatf_txn_count > 0 THEN 1 ELSE 0 END AS DOUBLE) * {d(0.35)} + "
           f"{_c01('zf.international_ratio')} * {d(0.20)} + {_N('sum_westernunion')} * {d(0.15)} + "
           f"CAST(CASE WHEN zf.drug_country_txn_count > 0 THEN 1 ELSE 0 END AS DOUBLE) * {d(0.10)} + "
           f"{_N1('greylist_txn_count')} * {d(0.10)} + {_N('sum_wire')} * {d(0.10)}")
HT_SQL = (f"{_N('card_adult_afterhours_count')} * {d(0.20)} + {_c01('zf.night_transaction_ratio')} * {d(0.10)} + "
          f"{_c01(_CITIES)} * {d(0.15)} + {_N('card_luxury_sum')} * {d(0.10)} + "
          f"{_N('card_accommodation_count')} * {d(0.10)} + {_c01(_N1('ht_source_country_txn_count'))} * {d(0.10)} + "
          f"{_N('card_travel_sum')} * {d(0.05)} + {_c01(_N('card_parking_count') + ' + ' + _N('card_delivery_count'))} * {d(0.05)} + "
          f"{_c01(_N('emt_debit_count') + ' + ' + _N('eft_debit_count'))} * {d(0.10)} + "
          f"{_c01(_N1('night_abm_count'))} * {d(0.05)}")

RISK = [f"{t}_risk" for t in K.TYPOLOGIES]

COMP_CTE = f"""
cp0 AS (
  SELECT zf.*,
    {_clip01(STRUCT_SQL)} AS structuring_layering_risk,
    {_clip01(BEHAV_SQL)} AS behavioural_profile_risk,
    {_clip01(TRADE_SQL)} AS trade_shell_risk,
    {_clip01(GEO_SQL)} AS cross_border_geo_risk,
    {_clip01(HT_SQL)} AS human_trafficking_risk
  FROM zf CROSS JOIN p99
),
cp AS (
  SELECT *, greatest({", ".join(RISK)}) AS overall_typology_max_risk,
    {" + ".join(f"CASE WHEN {r} > 0.3 THEN 1 ELSE 0 END" for r in RISK)} AS typology_breadth
  FROM cp0
)"""

IMPUTE_COLS = ["avg_transaction_amount", "median_transaction_amount", "min_transaction_amount",
               "max_transaction_amount", "inflow_outflow_ratio", "transactions_per_day", "volume_per_day",
               "inflow_per_day", "outflow_per_day", "ratio_below_10k", "ratio_round_1000",
               "avg_txn_per_city", "avg_txn_per_province", "international_ratio",
               "night_transaction_ratio", "evening_transaction_ratio", "weekend_ratio",
               "income", "occupation_code", "sales", "industry_code", "employee_count", "age",
               "customer_tenure_days"]

IMPUTE_CTE = f"""
med AS (
  SELECT {", ".join(f"quantile_cont({c}, 0.5) AS {c}" for c in IMPUTE_COLS)},
    CAST(floor(quantile_cont(time_span_days, 0.5) + 0.5) AS BIGINT) AS time_span_days FROM cp
),
ft AS (
  SELECT cp.* REPLACE ({", ".join(f"coalesce(cp.{c}, med.{c}) AS {c}" for c in IMPUTE_COLS)},
                       coalesce(cp.time_span_days, med.time_span_days) AS time_span_days),
    lk.label
  FROM cp CROSS JOIN med LEFT JOIN labels_known lk ON cp.customer_id = lk.customer_id
)"""


def ctes(*parts: str) -> str:
    return "WITH " + ",".join(p.strip("\n") for p in parts)


FEATURE_CTES = [TXN_CTES, KYC_CTES, WIDE_CTE, BEH_CTE, KYCF_CTE, SEG_CTE, COMP_CTE, IMPUTE_CTE]
