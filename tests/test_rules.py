"""Every ladder step of the rule table, checked at, just below and just above
its thresholds against an independent Python evaluation of the conditions."""

import random
import re


from txnrisk import constants as K
from txnrisk.operators import rules as R

ATOM = re.compile(r"([a-z_][a-z0-9_]*)\s*(>=|<=|>|<|=)\s*([0-9.]+)")


def thresholds() -> dict[str, set[float]]:
    out: dict[str, set[float]] = {}
    for typ in K.TYPOLOGIES:
        for _, ladders in R.RULES[typ]:
            for ladder in ladders:
                for cond, _ in ladder:
                    for name, _, num in ATOM.findall(cond):
                        out.setdefault(name, set()).add(float(num))
    return out


def py_cond(cond: str, row: dict) -> bool:
    expr = cond.replace(" AND ", " and ").replace(" OR ", " or ")
    expr = re.sub(r"(?<![<>=!])=(?!=)", "==", expr)
    return bool(eval(expr, {"abs": abs}, dict(row)))


def py_points(ladders, row) -> float:
    total = 0.0
    for ladder in ladders:
        step = 0.0
        for cond, pts in ladder:
            if py_cond(cond, row):
                step = pts
                break
        total = total + step
    return total


def make_rows(n=400, seed=7):
    rng = random.Random(seed)
    th = thresholds()
    names = R.referenced_features()
    rows = []
    for i in range(n):
        r = {}
        for name in names:
            opts = [0.0]
            for t in th.get(name, []):
                opts += [t, t - 0.001, t + 0.001]
            if name in ("income", "sales"):
                opts += [0.0, 1000.0, 50000.0]
            r[name] = rng.choice(opts)
        rows.append(r)
    return rows


def test_every_ladder_matches_python(spark):
    rows = make_rows()
    names = R.referenced_features()
    df = spark.createDataFrame([tuple([i] + [r[n] for n in names]) for i, r in enumerate(rows)],
                               ["customer_id"] + names)
    pts = R.with_rule_summary(R.rule_points(df)).orderBy("customer_id").collect()
    for i, r in enumerate(rows):
        rr = dict(r)
        rr["card_surge_ratio"] = r["card_volume_30d"] / r["card_volume_90d"] if r["card_volume_90d"] > 0 else 0.0
        rr["max_eft_emt_debit"] = max(r["emt_debit_count"], r["eft_debit_count"])
        for typ in K.TYPOLOGIES:
            s = 0.0
            for ind, ladders in R.RULES[typ]:
                exp = py_points(ladders, rr)
                got = pts[i][R.indicator_column_name(typ, ind)]
                assert abs(got - exp) < 1e-12, (typ, ind, rr, got, exp)
                s = s + exp
            assert abs(pts[i][f"rule_{typ}"] - min(max(s, 0.0), 1.0)) < 1e-12


def test_thresholds_at_boundary(spark):
    """Strict vs inclusive comparisons: '>' does not fire at the threshold, '>=' does."""
    base = {n: 0.0 for n in R.referenced_features()}
    cases = [
        ({"count_below_10k": 20}, "Struct::STRUCT-001", 0.20),
        ({"count_below_10k": 19.999}, "Struct::STRUCT-001", 0.10),
        ({"transactions_per_active_day": 20}, "Struct::STRUCT-006", 0.10),
        ({"transactions_per_active_day": 20.001}, "Struct::STRUCT-006", 0.20),
        ({"high_risk_fatf_txn_count": 3}, "Geo::GEO-002", 0.55),
        ({"high_risk_fatf_txn_count": 1}, "Geo::GEO-002", 0.40),
        ({"card_adult_afterhours_count": 1}, "HT::HT-SEX-12", 0.28),
        ({"emt_debit_count": 8, "eft_debit_count": 2}, "HT::HT-SEX-14", 0.18),
        ({"card_volume_30d": 10001, "card_volume_90d": 10001}, "Behav::ACCT-003", 0.20),
        ({"card_accommodation_count": 3, "unique_cities": 2}, "HT::HT-SEX-08", 0.12),
    ]
    rows = []
    for i, (vals, _, _) in enumerate(cases):
        r = dict(base)
        r.update({k: float(v) for k, v in vals.items()})
        rows.append(tuple([i] + [r[n] for n in R.referenced_features()]))
    df = spark.createDataFrame(rows, ["customer_id"] + R.referenced_features())
    got = {r["customer_id"]: r for r in R.rule_points(df).collect()}
    for i, (_, col, exp) in enumerate(cases):
        assert abs(got[i][col] - exp) < 1e-12, (i, col, got[i][col], exp)


def test_missing_feature_reads_zero(spark):
    df = spark.createDataFrame([(1, 25.0)], ["customer_id", "count_below_10k"])
    r = R.rule_points(df).first()
    assert r["Struct::STRUCT-001"] == 0.20
    assert r["rule_trade_shell"] == 0.0


def test_rule_summary_counts_typologies_not_indicators(spark):
    df = spark.createDataFrame([(1, 25.0, 25.0)], ["customer_id", "count_below_10k", "unique_cities"])
    r = R.with_rule_summary(R.rule_points(df)).first()
    assert r["rules_triggered"] == 1
    assert abs(r["rule_score_weighted"] - (0.20 + 0.20) * 0.30) < 1e-12  # STRUCT-001 + BEHAV-001
    assert r["primary_rule_typology"] == "Structuring & Layering"


# One case per indicator, worked out by hand: features (others 0) -> points.
# Values on a strict bound do not fire, values on an inclusive one do.
HAND_MADE = [
    ("STRUCT-001", {"count_below_10k": 10, "ratio_below_10k": 0.91, "cash_struct_count": 5}, 0.10 + 0.10 + 0.07),
    ("STRUCT-006", {"transactions_per_active_day": 10.5, "volume_per_day": 5000}, 0.10 + 0.05),
    ("ATYPICAL-006", {"night_transaction_ratio": 0.61, "transaction_count_total": 20, "weekend_ratio": 0.71}, 0.12 + 0.10),
    ("ATYPICAL-007", {"flow_through_ratio": 0.95, "total_volume": 100001, "count_eft": 11, "count_emt": 10}, 0.25 + 0.10),
    ("BEHAV-001", {"unique_cities": 3, "unique_provinces": 3}, 0.10 + 0.10),
    ("PROF-006", {"total_volume": 500001, "income": 1, "spending_to_income_ratio": 5, "volume_per_day": 3001}, 0.18 + 0.08),
    ("PROF-007", {"ratio_round_100": 0.7, "transaction_count_total": 20, "ratio_round_1000": 0.41, "count_round_1000": 5}, 0.08 + 0.10 + 0.05),
    ("ACCT-001", {"max_days_between_txns": 180, "total_volume": 10001, "monthly_volume_cv": 3.1, "customer_tenure_days": 181}, 0.15 + 0.12),
    ("ACCT-002", {"monthly_txn_count_std": 51, "monthly_volume_cv": 2.1, "active_days": 29, "time_span_days": 100, "channel_concentration_hhi": 0.86}, 0.12 + 0.15 + 0.08),
    ("ACCT-003", {"card_volume_30d": 7600, "card_volume_90d": 10000, "income": 20000, "sum_card": 20001, "amount_cv": 2.1, "count_card": 21}, 0.10 + 0.15 + 0.08),
    ("ACCT-004", {"monthly_volume_cv": 2.6, "monthly_txn_count_std": 31, "amount_cv": 3, "std_transaction_amount": 5001}, 0.15 + 0.10 + 0.08),
    ("PROD-008", {"sum_card": 20001, "card_luxury_sum": 15001, "card_luxury_count": 5, "income": 20000, "spending_to_income_ratio": 3.1}, 0.10 + 0.20 + 0.10),
    ("PROF-001", {"income": 1, "income_vol_ratio": 50, "total_volume": 100001, "customer_tenure_days": 179}, 0.10 + 0.15),
    ("PROF-002", {"income": 1, "total_outflow": 10001, "spending_to_income_ratio": 10}, 0.18),
    ("PROF-005", {"income": 1, "spending_to_income_ratio": 3.5, "card_luxury_sum": 5001}, 0.10 + 0.10),
    ("PROF-008", {"amount_cv": 3.1, "transaction_count_total": 20, "max_transaction_amount": 50001, "income": 25000, "avg_transaction_amount": 10001, "is_individual": 1}, 0.15 + 0.20 + 0.12),
    ("PROF-010", {"monthly_volume_cv": 3, "monthly_txn_count_std": 41, "amount_cv": 4.1}, 0.10 + 0.12 + 0.10),
    ("GATE-001", {"is_business": 1, "flow_through_ratio": 0.93, "total_volume": 200000, "net_flow": -3999}, 0.20 + 0.15),
    ("PML-TBML-02", {"industry_risk_high": 1, "volume_to_sales_ratio": 5, "is_business": 1, "count_wire": 6}, 0.12 + 0.10),
    ("PML-TBML-03", {"is_business": 1, "count_wire": 20, "count_eft": 51, "sum_wire": 500001}, 0.12 + 0.15 + 0.20),
    ("PML-TBML-04", {"eft_credit_sum": 500000, "monthly_txn_cv": 2.1, "is_business": 1, "inflow_per_day": 5001}, 0.18 + 0.10 + 0.10),
    ("PML-TBML-08", {"is_business": 1, "ratio_round_1000": 0.6, "count_round_1000": 10}, 0.10 + 0.10),
    ("PROF-004", {"sales": 1, "total_volume": 50001, "volume_to_sales_ratio": 20.5, "is_business": 1, "employee_count": 2}, 0.30 + 0.20),
    ("GEO-001", {"drug_country_txn_count": 5}, 0.25),
    ("GEO-002", {"high_risk_fatf_txn_count": 2}, 0.40),
    ("GEO-003", {"greylist_txn_count": 9, "offshore_center_txn_count": 3, "underground_banking_country_count": 2}, 0.10 + 0.18 + 0.10),
    ("GEO-004", {"has_any_high_risk_txn": 1}, 0.10),
    ("GEO-005", {"international_ratio": 0.8, "international_txn_count": 10, "unique_countries": 5, "sum_westernunion": 10000, "count_westernunion": 5, "card_unique_countries": 4}, 0.10 + 0.10 + 0.06 + 0.08 + 0.08),
    ("WIRE-008", {"sum_wire": 100001, "income": 100000}, 0.15 + 0.10),
    ("WIRE-010", {"count_wire": 14}, 0.10),
    ("HT-SEX-01", {"card_retail_count": 9, "ratio_round_100": 0.51}, 0.10),
    ("HT-SEX-02", {"card_retail_count": 10, "avg_transaction_amount": 200.5}, 0.12),
    ("HT-SEX-03", {"card_luxury_sum": 10000, "income": 1, "spending_to_income_ratio": 2.1, "card_luxury_count": 5}, 0.15 + 0.08),
    ("HT-SEX-04", {"card_parking_count": 20, "unique_cities": 2}, 0.08),
    ("HT-SEX-05", {"card_delivery_count": 20, "card_accommodation_count": 3}, 0.15),
    ("HT-SEX-06", {"card_digital_count": 4}, 0.08),
    ("HT-SEX-07", {"unique_cities": 5, "night_abm_count": 4}, 0.22),
    ("HT-SEX-08", {"card_accommodation_count": 4, "unique_cities": 2, "card_accommodation_sum": 2001}, 0.12 + 0.08),
    ("HT-SEX-10", {"ht_source_country_txn_count": 4, "card_travel_sum": 5000, "sum_westernunion": 2001}, 0.15 + 0.12 + 0.10),
    ("HT-SEX-12", {"card_afterhours_count": 10, "night_transaction_ratio": 0.41, "transaction_count_total": 10}, 0.12),
    ("HT-SEX-13", {"income": 1, "total_volume": 200001, "spending_to_income_ratio": 10}, 0.12),
    ("HT-SEX-14", {"emt_debit_count": 3, "eft_debit_count": 7}, 0.10),
]


def test_hand_made_case_per_indicator(spark):
    column = {ind: R.indicator_column_name(typ, ind) for typ in K.TYPOLOGIES for ind, _ in R.RULES[typ]}
    assert sorted(column) == sorted(ind for ind, _, _ in HAND_MADE)
    names = R.referenced_features()
    rows = [tuple([i, *[float(values.get(n, 0.0)) for n in names]]) for i, (_, values, _) in enumerate(HAND_MADE)]
    assert all(set(values) <= set(names) for _, values, _ in HAND_MADE)
    got = {r["customer_id"]: r for r in R.rule_points(spark.createDataFrame(rows, ["customer_id", *names])).collect()}
    wrong = [(ind, got[i][column[ind]], points) for i, (ind, _, points) in enumerate(HAND_MADE)
             if abs(got[i][column[ind]] - points) > 1e-12]
    assert not wrong
