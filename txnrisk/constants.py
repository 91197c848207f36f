"""Fixed values.

Everything in this module is a fixed value that must equal the studied
pipeline's for results to match: channel names, country lists, merchant
category codes, risk codes, typology weights and labels, feature-set lists,
and the indicator catalogue. They are stated plainly, in their natural order.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES: transaction channels (one source table each)
# ---------------------------------------------------------------------------
CHANNELS = ["ABM", "Card", "Cheque", "EFT", "EMT", "WesternUnion", "Wire"]

# Columns every channel is padded to before the union.
REQUIRED_TXN_COLUMNS = [
    "customer_id", "amount_cad", "debit_credit", "transaction_datetime",
    "country", "province", "city", "merchant_category", "ecommerce_ind",
]

# ---------------------------------------------------------------------------
# FIXED VALUES: KYC risk codes
# ---------------------------------------------------------------------------
HIGH_RISK_OCCUPATION_CODES = [
    11100, 11101, 11102, 41101, 63100, 63101, 63210, 65100, 70010, 73300, 75200,
]
HIGH_RISK_INDUSTRY_CODES = [
    4011, 4013, 4021, 4022, 4491, 4581, 5511, 6311, 6312, 6561, 7214, 7215, 7292,
    7421, 7511, 7512, 7599, 7611, 7731, 7739, 7761, 7791, 8132, 9111, 9114, 9211,
    9212, 9641, 9711, 9712, 7499,
]
HT_ACCOMMODATION_INDUSTRY_CODES = [9111, 9114]

# ---------------------------------------------------------------------------
# FIXED VALUES: country lists (ISO alpha-2)
# ---------------------------------------------------------------------------
HIGH_RISK_FATF = ["KP", "IR", "MM"]
GREYLIST = ["AL", "BB", "BF", "KH", "HR", "JM", "JO", "ML", "MZ", "NI", "PK", "PA",
            "PH", "SN", "SY", "TZ", "TR", "UG", "AE", "VN", "YE"]
OFFSHORE = ["KY", "BM", "VG", "PA", "LI", "MC", "AD", "BS", "LU"]
DRUG_COUNTRIES = ["MX", "CO", "PE", "BO", "VE", "GT", "HN", "EC", "BR"]
UNDERGROUND_BANKING_COUNTRIES = ["CN", "HK", "PH", "VN", "IN", "PK"]
HT_SOURCE_COUNTRIES = ["CN", "KR", "PH", "VN", "TH", "MX", "CO", "BR", "NG", "GH"]
DOMESTIC_COUNTRY = "CA"

# (feature column, country list) in feature order
GEO_RISK_SETS = [
    ("drug_country_txn_count", DRUG_COUNTRIES),
    ("high_risk_fatf_txn_count", HIGH_RISK_FATF),
    ("greylist_txn_count", GREYLIST),
    ("offshore_center_txn_count", OFFSHORE),
    ("underground_banking_country_count", UNDERGROUND_BANKING_COUNTRIES),
    ("ht_source_country_txn_count", HT_SOURCE_COUNTRIES),
]

# ---------------------------------------------------------------------------
# FIXED VALUES: merchant category code groups (card channel)
# ---------------------------------------------------------------------------
MCC_RETAIL = ["5411", "5912", "5310", "5331", "5300", "5499"]
MCC_LUXURY = ["5094", "5944", "5945", "5661", "5699"]
MCC_PARKING = ["7523", "4121"]
MCC_FOOD_DELIVERY = ["5814", "5812", "5499"]
MCC_DIGITAL = ["4816", "7995", "5816", "5968", "5815"]
MCC_ACCOMMODATION = ["7011", "7012"]
MCC_TRAVEL = ["4511", "4722", "4723"]
MCC_AIRLINE_RANGE = (3000, 3299)  # inclusive; airline carrier codes count as travel
MCC_ADULT_SPA = ["7297", "7298"]

# ---------------------------------------------------------------------------
# FIXED VALUES: thresholds used by the feature blocks
# ---------------------------------------------------------------------------
REPORTING_THRESHOLD = 10000.0
NEAR_THRESHOLD_LOW = 9000.0
VERY_NEAR_THRESHOLD_LOW = 9800.0
NIGHT_START_HOUR, NIGHT_END_HOUR = 22, 5        # hour >= 22 or hour <= 5
EVENING_START_HOUR, EVENING_END_HOUR = 18, 21   # 18 <= hour <= 21
WEEKEND_DAYS = [5, 6]                           # Monday = 0
CARD_RECENCY_WINDOWS = [30, 90]                 # days before own last card date
HIGH_RISK_SCORE = 0.60                          # "high risk" extract threshold
EVIDENCE_SCORE = 0.50                           # evidence table threshold

# ---------------------------------------------------------------------------
# FIXED VALUES: typologies
# ---------------------------------------------------------------------------
TYPOLOGIES = [
    "structuring_layering",
    "behavioural_profile",
    "trade_shell",
    "cross_border_geo",
    "human_trafficking",
]
TYPOLOGY_WEIGHTS = {
    "structuring_layering": 0.30,
    "behavioural_profile": 0.20,
    "trade_shell": 0.25,
    "cross_border_geo": 0.13,
    "human_trafficking": 0.12,
}
# Short display labels (fusion stage)
TYPOLOGY_LABELS = {
    "structuring_layering": "Structuring & Layering",
    "behavioural_profile": "Behavioural & Profile Anomalies",
    "trade_shell": "Trade-Based ML & Shell Entities",
    "cross_border_geo": "Cross-Border & Geographic Risk",
    "human_trafficking": "Human Trafficking",
}
# Long labels used by the anomaly stage's primary typology
TYPOLOGY_LONG_LABELS = {
    "structuring_layering": "Structuring & Layering (STRUCT-001..009, ATYPICAL-006..008, BEHAV-001)",
    "behavioural_profile": "Behavioural & Profile Anomalies (PROF-001..010, ACCT-001..004)",
    "trade_shell": "Trade-Based ML & Shell Entities (PML-TBML-02..08, PROF-004, GATE-001)",
    "cross_border_geo": "Cross-Border & Geographic Risk (GEO-001..005, WIRE-008/010)",
    "human_trafficking": "Human Trafficking (HT-SEX-01..14)",
}
# Trace prefixes
TYPOLOGY_PREFIX = {
    "structuring_layering": "Struct",
    "behavioural_profile": "Behav",
    "trade_shell": "Trade",
    "cross_border_geo": "Geo",
    "human_trafficking": "HT",
}
GENERAL_LOW_RISK_LABEL = "General — Low Risk"
CLUSTER_LOW_RISK_CUTOFF = 0.20
COMPOSITE_BREADTH_CUTOFF = 0.3

# Risk bands, highest first: (lower bound inclusive, label)
RISK_BANDS = [(0.80, "Very High"), (0.60, "High"), (0.40, "Medium"), (0.20, "Low")]
RISK_BAND_FLOOR = "Very Low"

# Fusion pillar weights
PILLAR_DYNAMIC, PILLAR_FALLBACK, PILLAR_PEER = 0.50, 0.20, 0.30

# Trace filtering
TRACE_MIN_IMPACT = 0.015
TRACE_TOP_N = 5
TRACE_SEVERITY_HIGH = 0.20   # points > this -> H
TRACE_SEVERITY_MEDIUM = 0.10  # points >= this -> M, else L

# Trace prefix aliases read back when counting a trace (lower-cased prefix -> typology)
TRACE_PREFIX_ALIASES = {
    "struct": "structuring_layering",
    "structuring": "structuring_layering",
    "structuring_layering": "structuring_layering",
    "behav": "behavioural_profile",
    "behavioural": "behavioural_profile",
    "behavioural_profile": "behavioural_profile",
    "trade": "trade_shell",
    "trade_shell": "trade_shell",
    "geo": "cross_border_geo",
    "cross_border_geo": "cross_border_geo",
    "cross-border": "cross_border_geo",
    "ht": "human_trafficking",
    "human_trafficking": "human_trafficking",
}

# ---------------------------------------------------------------------------
# FIXED VALUES: anomaly-model inputs
# ---------------------------------------------------------------------------
FOREST_TREES = 300
FOREST_SAMPLE = 256
FOREST_SEED = 42
KMEANS_START_K = 8
KMEANS_RESTARTS = 20
KMEANS_MIN_CLUSTER = 200
KMEANS_K_FLOOR = 3
NARRATIVE_QUEUE = 600
NARRATIVE_BATCH = 300

EXCLUDE_MODEL_COLS = [
    "customer_id", "label",
    "first_transaction_date", "last_transaction_date",
    "birth_date", "onboard_date", "established_date",
    "customer_type", "occupation_code", "industry_code",
    "day_name", "time_of_day", "year_month",
]

LOG_TRANSFORM_PATTERNS = [
    "volume", "outflow", "inflow", "sum_", "count_",
    "total_", "amount", "txn_count", "net_flow",
    "international_txn", "drug_country", "greylist", "offshore",
    "employee", "night_", "ht_source", "card_",
    "max_days_between",
    "avg_txn_per",
    "_vs_ind_median",
    "_vs_bus_median",
]

# Each entry is an exact column name or a substring pattern.
TYPOLOGY_FEATURE_PATTERNS = {
    "structuring_layering": [
        "count_near_10k", "count_very_near_10k", "count_below_10k", "ratio_below_10k",
        "cash_struct_count", "count_round_100", "ratio_round_100", "count_round_1000",
        "ratio_round_1000", "flow_through_ratio", "transactions_per_active_day",
        "volume_per_day", "unique_cities", "unique_provinces", "count_abm", "sum_abm",
        "count_eft", "sum_eft", "count_emt", "sum_emt", "count_wire", "sum_wire",
        "count_cheque", "max_days_between_txns", "total_volume_vs_ind_median",
        "total_volume_vs_bus_median", "total_volume_above_ind_p90",
        "total_volume_above_bus_p90", "transactions_per_active_day_vs_ind_median",
        "transactions_per_active_day_vs_bus_median",
        "transactions_per_active_day_above_ind_p90",
        "transactions_per_active_day_above_bus_p90", "flow_through_ratio_vs_ind_median",
        "flow_through_ratio_vs_bus_median", "outflow_per_day", "sum_cheque", "has_emt",
        "structuring_layering_risk",
    ],
    "behavioural_profile": [
        "spending_to_income_ratio", "income_vol_ratio", "monthly_volume_cv",
        "monthly_txn_count_std", "amount_cv", "std_transaction_amount",
        "max_transaction_amount", "avg_transaction_amount", "channel_diversity",
        "channel_concentration_hhi", "count_card", "sum_card", "transaction_count_total",
        "net_flow", "active_days", "time_span_days", "customer_tenure_days",
        "is_individual", "age", "occupation_risk_high", "max_days_between_txns",
        "total_outflow_vs_ind_median", "total_outflow_vs_bus_median",
        "total_outflow_above_ind_p90", "total_outflow_above_bus_p90",
        "total_inflow_vs_ind_median", "total_inflow_vs_bus_median",
        "total_inflow_above_ind_p90", "total_inflow_above_bus_p90", "card_volume_30d",
        "card_volume_90d", "card_30d_ratio", "card_90d_ratio", "card_ecommerce_count",
        "card_ecommerce_sum", "evening_transaction_ratio", "total_volume",
        "total_outflow", "transaction_count_debit", "transaction_count_credit",
        "median_transaction_amount", "behavioural_profile_risk", "card_30d_ratio",
    ],
    "trade_shell": [
        "volume_to_sales_ratio", "industry_risk_high", "employee_count",
        "flow_through_ratio", "eft_credit_sum", "eft_credit_count", "sum_eft",
        "count_eft", "sum_wire", "count_wire", "ratio_round_1000", "count_round_1000",
        "monthly_txn_cv", "is_business", "has_wire", "has_eft", "inflow_per_day",
        "total_inflow", "eft_debit_count", "eft_debit_sum", "total_inflow_vs_bus_median",
        "total_inflow_above_bus_p90", "total_volume_vs_bus_median",
        "total_volume_above_bus_p90", "flow_through_ratio_vs_bus_median",
        "avg_txn_per_city", "flow_through_ratio_above_ind_p90",
        "flow_through_ratio_above_bus_p90", "trade_shell_risk",
    ],
    "cross_border_geo": [
        "drug_country_txn_count", "high_risk_fatf_txn_count", "greylist_txn_count",
        "offshore_center_txn_count", "underground_banking_country_count",
        "international_txn_count", "international_txn_sum", "international_ratio",
        "unique_countries", "has_any_high_risk_txn", "sum_westernunion",
        "count_westernunion", "has_western_union", "sum_wire", "count_wire",
        "card_unique_countries", "card_unique_cities", "ht_source_country_txn_count",
        "cross_border_geo_risk",
    ],
    "human_trafficking": [
        "card_adult_afterhours_count", "card_afterhours_count", "night_transaction_ratio",
        "night_abm_count", "unique_cities", "unique_provinces", "card_accommodation_count",
        "card_accommodation_sum", "card_luxury_sum", "card_luxury_count",
        "card_travel_sum", "card_travel_count", "ht_source_country_txn_count",
        "card_parking_count", "card_delivery_count", "card_digital_count",
        "card_retail_count", "emt_debit_count", "eft_debit_count",
        "spending_to_income_ratio", "sum_westernunion", "ht_accommodation_sector",
        "is_individual", "weekend_ratio", "card_retail_sum", "card_digital_sum",
        "card_unique_cities", "emt_credit_count", "emt_credit_sum", "emt_debit_sum",
        "eft_debit_sum", "avg_txn_per_city", "card_volume_30d", "card_30d_ratio",
        "overall_typology_max_risk", "typology_breadth", "night_transaction_count",
        "evening_transaction_count", "weekend_transaction_count",
        "human_trafficking_risk",
    ],
}

# ---------------------------------------------------------------------------
# FIXED VALUES: request records, responses and narratives
# ---------------------------------------------------------------------------
REQUEST_FIELDS = [
    "customer_id", "final_hybrid_score", "hybrid_risk_category", "coverage",
    "primary_rule_typology", "rules_triggered", "rule_indicator_trace",
    "rule_human_trafficking", "rule_structuring_layering", "rule_behavioural_profile",
    "rule_trade_shell", "rule_cross_border_geo", "if_score_max",
    "if_score_human_trafficking", "if_score_structuring_layering",
    "if_score_behavioural_profile", "if_score_trade_shell", "if_score_cross_border_geo",
    "cluster_primary_typology", "cluster_risk_tier",
]
RESPONSE_HEADER = ["customer_id", "explanation"]
RESPONSE_FAILED = "unsuccessful"
NARRATIVE_MAX_CHARS = 2000
NARRATIVE_MIN_SENTENCES, NARRATIVE_MAX_SENTENCES = 3, 5
LOW_COVERAGE_CUTOFF = 0.60
LOW_COVERAGE_SENTENCE = (
    "Note: limited transaction history is available for this customer; the risk "
    "assessment relies partly on profile-based heuristics and should be weighted accordingly."
)

# ---------------------------------------------------------------------------
# FIXED VALUES: indicator catalogue
# (indicator id, category, sub category, risk level, typology key,
#  transaction types, co-occurring indicator ids)
# ---------------------------------------------------------------------------
CATALOGUE = [
    ("ATYPICAL-006", "Atypical Transactions", "Temporal Transaction Pattern", "Medium", "structuring_layering", "All", "STRUCT-001, STRUCT-006, PROF-007"),
    ("ATYPICAL-007", "Atypical Transactions", "Quick In-Out", "High", "structuring_layering", "All", "ATYPICAL-008, WIRE-008, ACCT-001, STRUCT-001"),
    ("ATYPICAL-008", "Atypical Transactions", "Same-Day Turnover", "High", "structuring_layering", "All", "ATYPICAL-007, WIRE-008, ACCT-001"),
    ("BEHAV-001", "Client Behavior", "Location Hopping", "Medium", "structuring_layering", "ABM, Card", "STRUCT-001, STRUCT-006, ATYPICAL-007"),
    ("PROF-006", "Profile Mismatch", "Fund Movement", "High", "structuring_layering", "All", "ATYPICAL-007, ATYPICAL-008, WIRE-008, PROF-010"),
    ("PROF-007", "Profile Mismatch", "Round Sums", "Low", "structuring_layering", "All", "STRUCT-001, STRUCT-006, ATYPICAL-006"),
    ("STRUCT-001", "Structuring", "Cash Structuring", "High", "structuring_layering", "ABM", "STRUCT-006, BEHAV-001, ATYPICAL-006, PROF-007"),
    ("STRUCT-006", "Structuring", "Short Period Multiple Transactions", "High", "structuring_layering", "All", "STRUCT-001, BEHAV-001, ATYPICAL-006"),
    ("ACCT-001", "Account Activity", "Dormant Activation", "Medium", "behavioural_profile", "All", "ATYPICAL-007, ATYPICAL-008, WIRE-008"),
    ("ACCT-002", "Account Activity", "Periodic Patterns", "Medium", "behavioural_profile", "ABM, EFT, EMT, Cheque, Wire", "ACCT-001, ATYPICAL-006, STRUCT-006"),
    ("ACCT-003", "Account Activity", "Credit Surge", "Medium", "behavioural_profile", "Card", "PROD-008, ACCT-004, PROF-001"),
    ("ACCT-004", "Account Activity", "Abrupt Change", "Medium", "behavioural_profile", "All", "PROF-010, ACCT-001, PROF-001"),
    ("PROD-008", "Products & Services", "Credit Card Abuse", "High", "behavioural_profile", "Card", "ACCT-003, HT-SEX-01, HT-SEX-02"),
    ("PROF-001", "Profile Mismatch", "Activity vs Expectation", "High", "behavioural_profile", "All", "PROF-002, PROF-006, ACCT-004, PROF-010"),
    ("PROF-002", "Profile Mismatch", "Financial Standing", "High", "behavioural_profile", "All", "PROF-001, PROF-005, ATYPICAL-007, WIRE-010"),
    ("PROF-003", "Profile Mismatch", "Geographic Volume", "Medium", "behavioural_profile", "All", "GEO-001, GEO-002, PROF-004"),
    ("PROF-005", "Profile Mismatch", "Living Beyond Means", "Medium", "behavioural_profile", "All", "PROF-002, PROD-008, HT-SEX-03"),
    ("PROF-008", "Profile Mismatch", "Transaction Type/Size", "Medium", "behavioural_profile", "All", "PROF-001, PROF-010, ACCT-004"),
    ("PROF-010", "Profile Mismatch", "Sudden Change", "High", "behavioural_profile", "All", "PROF-001, ACCT-004, PROF-006"),
    ("GATE-001", "Gatekeeper Misuse", "Atypical Account Use", "High", "trade_shell", "All", "PROF-004, PML-TBML-02, WIRE-008"),
    ("PML-TBML-02", "Trade-Based ML", "Sector Deviation", "Medium", "trade_shell", "All", "PML-TBML-03, PROF-004, GATE-001"),
    ("PML-TBML-03", "Trade-Based ML", "Counterparty Risk", "High", "trade_shell", "Wire, EFT", "PML-TBML-02, PML-TBML-04, PML-TBML-08"),
    ("PML-TBML-04", "Trade-Based ML", "Volume Spike", "High", "trade_shell", "EFT", "PML-TBML-03, WIRE-008, ATYPICAL-008"),
    ("PML-TBML-08", "Trade-Based ML", "Round Sums", "High", "trade_shell", "Wire, EFT", "PML-TBML-04, STRUCT-001, PROF-007"),
    ("PROF-004", "Profile Mismatch", "Business Activity", "High", "trade_shell", "All", "GATE-001, PML-TBML-02, PROF-006"),
    ("GEO-001", "Geographic Risk", "Drug Jurisdictions", "High", "cross_border_geo", "Card, Wire, Western Union", "GEO-002, GEO-004, WIRE-008"),
    ("GEO-002", "Geographic Risk", "High ML/TF Risk", "High", "cross_border_geo", "Card, Wire, Western Union", "GEO-001, GEO-003, GEO-004, WIRE-008"),
    ("GEO-003", "Geographic Risk", "Locations of Concern", "High", "cross_border_geo", "Card, Wire, Western Union", "GEO-002, GEO-004"),
    ("GEO-004", "Geographic Risk", "FATF Non-Cooperative", "High", "cross_border_geo", "Card, Wire, Western Union", "GEO-001, GEO-002, GEO-003"),
    ("GEO-005", "Geographic Risk", "Frequent Overseas Transfers", "Medium", "cross_border_geo", "Wire, Western Union", "GEO-002, WIRE-008, WIRE-010"),
    ("WIRE-008", "Wire Transfers", "Volume Mismatch", "High", "cross_border_geo", "Wire", "WIRE-010, ATYPICAL-007, ATYPICAL-008, GEO-002"),
    ("WIRE-010", "Wire Transfers", "Multiple Senders/Receivers", "Medium", "cross_border_geo", "Wire", "WIRE-008, PROF-006, GEO-005"),
    ("HT-SEX-01", "Crimes & High-Risk Entities", "Retail & Gift Card Anomalies", "Medium", "human_trafficking", "Card", "HT-SEX-02, HT-SEX-07, HT-SEX-08"),
    ("HT-SEX-02", "Crimes & High-Risk Entities", "Retail & Gift Card Anomalies", "Medium", "human_trafficking", "Card", "HT-SEX-01, HT-SEX-07, HT-SEX-04"),
    ("HT-SEX-03", "Crimes & High-Risk Entities", "Lifestyle & Luxury Spend", "High", "human_trafficking", "Card", "HT-SEX-13, PROF-005, HT-SEX-06"),
    ("HT-SEX-04", "Crimes & High-Risk Entities", "Logistics & Victim Maintenance", "Low", "human_trafficking", "Card", "HT-SEX-05, HT-SEX-07, HT-SEX-08"),
    ("HT-SEX-05", "Crimes & High-Risk Entities", "Logistics & Victim Maintenance", "Low", "human_trafficking", "Card", "HT-SEX-04, HT-SEX-07"),
    ("HT-SEX-06", "Crimes & High-Risk Entities", "Digital Integration", "Medium", "human_trafficking", "Card", "HT-SEX-03, HT-SEX-13, HT-SEX-01"),
    ("HT-SEX-07", "Crimes & High-Risk Entities", "Geographic & Travel Patterns", "High", "human_trafficking", "ABM, Card", "HT-SEX-08, HT-SEX-10, HT-SEX-04"),
    ("HT-SEX-08", "Crimes & High-Risk Entities", "Geographic & Travel Patterns", "Medium", "human_trafficking", "Card", "HT-SEX-07, HT-SEX-10, HT-SEX-04"),
    ("HT-SEX-10", "Crimes & High-Risk Entities", "International Recruitment & Travel", "High", "human_trafficking", "Card", "HT-SEX-07, HT-SEX-08, HT-SEX-13"),
    ("HT-SEX-12", "Crimes & High-Risk Entities", "Illicit Storefront Operations", "High", "human_trafficking", "Card", "HT-SEX-07, HT-SEX-08, HT-SEX-01"),
    ("HT-SEX-13", "Crimes & High-Risk Entities", "Asset Procurement & Management", "High", "human_trafficking", "Wire, Cheque", "HT-SEX-14, HT-SEX-03, HT-SEX-06"),
    ("HT-SEX-14", "Crimes & High-Risk Entities", "Asset Procurement & Management", "Medium", "human_trafficking", "EFT, EMT, Wire", "HT-SEX-13, HT-SEX-07"),
]


# ---------------------------------------------------------------------------
# FIXED VALUES: indicator -> associated merchant category codes
# ---------------------------------------------------------------------------
INDICATOR_MCC = {
    "ATYPICAL-001": [5094, 5944, 5681, 5971, 5972, 5309, 5311, 5399, 5999],
    "ATYPICAL-006": [6010, 6011, 6012, 6050, 6051, 5094, 5944, 5971, 5309, 5311, 5399, 5999],
    "ATYPICAL-007": [4829, 6530, 6535, 6536, 6537, 6538, 6539, 6540, 6010, 6011, 6050, 6051],
    "ATYPICAL-008": [4829, 6530, 6535, 6536, 6537, 6538, 6539, 6540],
    "STRUCT-001": [6010, 6011, 6050, 6051, 5300, 5310, 5331, 5411, 5499, 5541, 5542],
    "ACCT-001": [4829, 6530, 6535, 6536, 6537, 6538, 6539, 6540, 6211],
    "GAMBLING-001": [7800, 7801, 7802, 7995],
    "CASH-001": [6010, 6011, 6012, 6050, 6051],
    "TRANSFER-001": [4829, 6536, 6537, 6538, 6539, 6540],
    "RETAIL-001": [5300, 5310, 5311, 5331, 5399, 5411, 5499, 5541, 5542],
    "RETAIL-002": [5948, 5946, 5732, 5045, 5942, 5311, 5399, 5999],
    "SECONDARY-001": [5933, 5931, 5932],
    "TRAVEL-001": [3000, 3351, 3501, 7011, 4722],
    "DIGITAL-001": [5815, 5816, 5817, 5818, 5961, 5962, 5964, 5965, 5966, 5967, 5968, 5969],
    "REMOTE-001": [5961, 5962, 5963, 5964, 5965, 5966, 5967, 5968, 5969],
    "LIFESTYLE-001": [5921, 5813],
    "INSURANCE-001": [6300],
    "GOV-001": [9211, 9222, 9311],
    "SERVICE-001": [7210, 7211, 7276, 7277, 7399],
}

# FIXED VALUES: descriptions of merchant category codes
MCC_DESCRIPTIONS = {
    5094: "Precious Stones and Metals, Watches and Jewelry",
    5944: "Clock, Jewelry, Watch and Silverware Stores",
    5681: "Furriers and Fur Shops",
    5971: "Art Dealers and Galleries",
    5972: "Stamp and Coin Stores",
    5309: "Duty Free Stores",
    5311: "Department Stores",
    5399: "Miscellaneous General Merchandise Stores",
    5999: "Miscellaneous and Specialty Retail Stores",
    6010: "Manual Cash Disbursements",
    6011: "Automated Cash Disbursements (ATM)",
    6012: "Financial Institution Merchandise and Services",
    6050: "Quasi Cash – Financial Institution",
    6051: "Quasi Cash – Merchant",
    4829: "Wire Transfer Money Orders",
    6530: "Stored Value Load – Merchant",
    6535: "Value Purchase – Financial Institution",
    6536: "MoneySend Intracountry",
    6537: "MoneySend Intercountry",
    6538: "MoneySend Funding",
    6539: "Funding Transaction",
    6540: "Point of Interaction Funding Transactions",
    7800: "Government-Owned Lottery",
    7801: "Licensed Online Casinos",
    7802: "Horse/Dog Racing",
    7995: "Gambling Transactions",
    5933: "Pawn Shops",
    5931: "Second Hand Stores",
    5932: "Antique Shops",
    3000: "Airlines (General Category)",
    3351: "Car Rental Agencies",
    3501: "Hotels, Motels, Resorts",
    7011: "Lodging Services",
    4722: "Travel Agencies and Tour Operators",
    5948: "Leather Goods and Luggage Stores",
    5946: "Camera and Photographic Supply Stores",
    5732: "Electronics Stores",
    5045: "Computers and Software",
    5942: "Book Stores (potential layering via resale)",
    5815: "Digital Goods – Books, Movies, Music",
    5816: "Digital Goods – Games",
    5817: "Digital Goods – Applications",
    5818: "Digital Goods – Multi-Category",
    5961: "Mail Order Houses",
    5962: "Direct Marketing – Travel",
    5963: "Door-to-Door Sales",
    5964: "Catalog Merchants",
    5965: "Combination Catalog and Retail",
    5966: "Outbound Telemarketing",
    5967: "Inbound Telemarketing",
    5968: "Subscription Merchants",
    5969: "Other Direct Marketing",
    5921: "Liquor Stores",
    5813: "Bars and Nightclubs",
    6211: "Securities Brokers and Dealers",
    6300: "Insurance Sales and Premiums",
    9211: "Court Costs",
    9222: "Fines",
    9311: "Tax Payments",
    7276: "Tax Preparation Services",
    7277: "Counseling Services",
    7399: "Business Services Not Elsewhere Classified",
    5499: "Miscellaneous Food Stores–Convenience Stores, Markets, Specialty Stores, and Vending Machines",
    7210: "Cleaning, Garment and Laundry Services",
    7211: "Laundry Services–Family and Commercial",
    5300: "Wholesale Clubs",
    5310: "Discount Stores",
    5331: "Variety Stores",
    5411: "Grocery Stores, Supermarkets",
    5541: "Service Stations (With or Without Ancillary Services)",
    5542: "Automated Fuel Dispensers",
}
# First codes whose description holds for a whole range of carriers or chains
# (inclusive ends, as the public code lists have them).
MCC_RANGES = {3000: MCC_AIRLINE_RANGE[1], 3351: 3441, 3501: 3999}
