"""End-to-end stage builders: inputs -> features -> rules -> scores.

Each function returns a DataFrame; the caller decides what to write. Stage
outputs that feed several consumers are written as parquet tables to the
shared folder named by ``spark.checkpoint.dir``, so a lost executor costs a
re-read, not a recompute from raw transactions, and readers scan only the
columns they need.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import CHANNELS
from ..operators import composites as C
from ..operators.features import behavioural_features
from ..operators.kyc import KYC_COLUMNS, attach_kyc_risk_tiers, kyc_features
from ..session import write_customer_table, write_stage_table
from ..sources import fixtures as FX
from ..sources.channels import clean_transactions, with_time_columns


@dataclass
class Inputs:
    txn: DataFrame
    kyc_ind: DataFrame
    kyc_bus: DataFrame
    occupation_codes: DataFrame
    industry_codes: DataFrame
    labels: DataFrame
    as_of: str = FX.AS_OF


def stage_transactions(txn: DataFrame) -> DataFrame:
    """The transaction table, written once, partitioned by channel and in each
    file by customer: aggregates per customer then meet a customer's rows one
    after another. A task has the files of all channels open, so rows are
    sorted by one number only. The time columns follow from the timestamp and
    are derived by the readers that use them."""
    conf, name = txn.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    was = conf.get(name, "0")
    conf.set(name, str(len(CHANNELS) + 1))  # a channel may be null
    try:
        staged = write_stage_table(txn.sortWithinPartitions("customer_id"), "unified-transactions", ["channel"])
    finally:
        conf.set(name, was)
    return with_time_columns(staged)


def fixture_inputs(spark: SparkSession, sf_dir: str, stage_txn: bool = True) -> Inputs:
    """Inputs derived from the driver's tables. The unified transaction table
    is written once (partitioned by channel, so card-only blocks read one
    partition) and every feature block scans that table."""
    txn = clean_transactions(FX.fixture_transactions(spark, sf_dir))
    return Inputs(
        txn=stage_transactions(txn) if stage_txn else with_time_columns(txn),
        kyc_ind=FX.fixture_kyc_individual(spark, sf_dir),
        kyc_bus=FX.fixture_kyc_business(spark, sf_dir),
        occupation_codes=FX.fixture_occupation_codes(spark, sf_dir),
        industry_codes=FX.fixture_industry_codes(spark, sf_dir),
        labels=FX.fixture_labels(spark, sf_dir),
    )


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """A stage output cut from its lineage, as a columnar table; bucketed by
    customer where it has one, as customers are what later stages join on."""
    return write_customer_table(df, name) if "customer_id" in df.columns else write_stage_table(df, name)


def customer_base(inp: Inputs, behavioural: DataFrame | None = None) -> DataFrame:
    """Behavioural features (``behavioural``, where they lie staged) + KYC,
    before population statistics."""
    beh = behavioural_features(inp.txn) if behavioural is None else behavioural
    ki, kb = attach_kyc_risk_tiers(inp.kyc_ind, inp.kyc_bus, inp.occupation_codes, inp.industry_codes)
    return kyc_features(beh, ki, kb, inp.as_of)


def feature_table(inp: Inputs, impute: bool = True, checkpoint: bool = True,
                  with_labels: bool = True, base: DataFrame | None = None) -> DataFrame:
    """The wide customer feature table (167 features + label). ``base``: the
    staged customer base, where there is one."""
    f = customer_base(inp) if base is None else base
    if checkpoint and base is None:
        f = materialize(f)
    f = C.with_profile_ratios(f)
    segments, p99, medians = C.population_stats(f)
    f = C.with_segment_ratios(f, segments)
    for c in C.COMPOSITE_INPUTS:
        f = f.withColumn(c, F.coalesce(F.col(c), F.lit(0.0)))
    f = C.with_composites(f, p99)
    if impute:
        f = C.with_imputation(f, medians)
    cols = ["customer_id"] + FEATURE_COLUMNS
    f = f.select(*cols)
    if with_labels:
        lab = inp.labels.groupBy("customer_id").agg(F.max("label").cast("int").alias("label"))
        f = f.join(lab, "customer_id", "left")
    if checkpoint:
        f = materialize(f)
    return f


def _feature_columns() -> list[str]:
    from ..operators.features import BEHAVIOURAL_COLUMNS
    kyc = KYC_COLUMNS + C.SEGMENT_COLUMNS + ["spending_to_income_ratio", "volume_to_sales_ratio",
                                             "income_vol_ratio"]
    return BEHAVIOURAL_COLUMNS + kyc + C.COMPOSITE_COLUMNS


FEATURE_COLUMNS = _feature_columns()
