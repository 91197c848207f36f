"""KYC dimension handling: risk tiers from code tables, de-duplication,
and the KYC-derived customer features."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.columns import bool_int, lit_d


def dedupe_by_customer(df: DataFrame) -> DataFrame:
    """Keep one KYC row per customer, deterministically (a duplicate KYC row
    would otherwise multiply that customer's features). Customer-level
    tables: the per-customer window sees a handful of rows at most."""
    order = [F.col(c).asc_nulls_last() for c in df.columns if c != "customer_id"]
    w = Window.partitionBy("customer_id").orderBy(*order)
    return (df.where(F.col("customer_id").isNotNull())
              .withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn"))


def _code_flags(codes: DataFrame, code_col: str, flags: dict[str, list[int]]) -> DataFrame:
    """Code table -> (code, flag...) with the code coerced to int (bad -> NULL).
    How it is joined is left to the optimizer, which knows its size."""
    c = F.expr(f"try_cast(cast({code_col} as string) as int)")
    t = codes.select(c.alias(code_col)).where(F.col(code_col).isNotNull()).distinct()
    for name, members in flags.items():
        t = t.withColumn(name, bool_int(F.col(code_col).isin(members)))
    return t


def attach_kyc_risk_tiers(kyc_ind: DataFrame, kyc_bus: DataFrame,
                          occupation_codes: DataFrame, industry_codes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Occupation / industry risk tiers onto KYC rows; unknown code -> 0."""
    occ = _code_flags(occupation_codes, "occupation_code",
                      {"occupation_risk_high": K.HIGH_RISK_OCCUPATION_CODES})
    ind = _code_flags(industry_codes, "industry_code",
                      {"industry_risk_high": K.HIGH_RISK_INDUSTRY_CODES,
                       "ht_accommodation_sector": K.HT_ACCOMMODATION_INDUSTRY_CODES})
    ki = dedupe_by_customer(kyc_ind).withColumn(
        "occupation_code", F.expr("try_cast(cast(occupation_code as string) as int)"))
    kb = dedupe_by_customer(kyc_bus).withColumn(
        "industry_code", F.expr("try_cast(cast(industry_code as string) as int)"))
    ki = (ki.join(occ, "occupation_code", "left")
            .withColumn("occupation_risk_high", F.coalesce("occupation_risk_high", F.lit(0))))
    kb = (kb.join(ind, "industry_code", "left")
            .withColumn("industry_risk_high", F.coalesce("industry_risk_high", F.lit(0)))
            .withColumn("ht_accommodation_sector", F.coalesce("ht_accommodation_sector", F.lit(0))))
    return ki, kb


KYC_COLUMNS = [
    "income", "occupation_code", "birth_date", "onboard_date", "occupation_risk_high",
    "sales", "industry_code", "employee_count", "established_date", "industry_risk_high",
    "ht_accommodation_sector", "customer_type", "is_business", "is_individual", "age",
    "customer_tenure_days",
]


def kyc_features(features: DataFrame, kyc_ind: DataFrame, kyc_bus: DataFrame, as_of: str) -> DataFrame:
    """Left-join KYC onto customer features and derive type, age and tenure.
    ``as_of`` replaces "now" so results are reproducible."""
    ki = kyc_ind.select("customer_id", F.col("income").cast("double").alias("income"),
                        F.col("occupation_code").cast("double").alias("occupation_code"),
                        F.col("birth_date").cast("date").alias("birth_date"),
                        F.col("onboard_date").cast("date").alias("onboard_date"),
                        F.col("occupation_risk_high").cast("int").alias("occupation_risk_high"))
    kb = kyc_bus.select("customer_id", F.col("sales").cast("double").alias("sales"),
                        F.col("industry_code").cast("double").alias("industry_code"),
                        F.col("employee_count").cast("double").alias("employee_count"),
                        F.col("established_date").cast("string").alias("established_date"),
                        F.col("industry_risk_high").cast("int").alias("industry_risk_high"),
                        F.col("ht_accommodation_sector").cast("int").alias("ht_accommodation_sector"))
    f = features.join(ki, "customer_id", "left").join(kb, "customer_id", "left")
    ctype = (F.when(F.col("sales").isNotNull(), F.lit("business"))
              .when(F.col("income").isNotNull(), F.lit("individual"))
              .otherwise(F.lit("unknown")))
    as_of_d = F.lit(as_of).cast("date")
    return (f.withColumn("customer_type", ctype)
             .withColumn("is_business", bool_int(F.col("customer_type") == "business"))
             .withColumn("is_individual", bool_int(F.col("customer_type") == "individual"))
             .withColumn("age", F.datediff(as_of_d, F.col("birth_date")) / lit_d(365.25))
             .withColumn("customer_tenure_days", F.datediff(as_of_d, F.col("onboard_date")).cast("double"))
             .withColumn("occupation_risk_high", F.coalesce("occupation_risk_high", F.lit(0)))
             .withColumn("industry_risk_high", F.coalesce("industry_risk_high", F.lit(0)))
             .withColumn("ht_accommodation_sector", F.coalesce("ht_accommodation_sector", F.lit(0))))
