"""Result sinks: scored tables and their high-risk extracts, the explanations
CSV, and batch-level checkpointing of narrative work (a re-run skips finished
batches). Models save themselves (``operators.models``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..session import write_stage_table
from .channels import path_exists


def high_risk_extract(scored: DataFrame, score: str, threshold: float = K.HIGH_RISK_SCORE) -> DataFrame:
    """Rows strictly above the threshold (the filtered companion of a full
    result table)."""
    return scored.where(F.col(score) > threshold)


def write_results(scored: DataFrame, path: str, score: str, threshold: float = K.HIGH_RISK_SCORE) -> None:
    """Full result table and its high-risk extract, both as parquet."""
    scored.write.mode("overwrite").parquet(f"{path.rstrip('/')}/all")
    high_risk_extract(scored, score, threshold).write.mode("overwrite").parquet(f"{path.rstrip('/')}/high_risk")


def explanations_csv(explanations: DataFrame) -> DataFrame:
    """customer_id, explanation with line breaks flattened and surrounding
    blanks trimmed; the writer quotes every field and doubles quotes."""
    return explanations.select(
        F.col("customer_id").cast("string").alias("customer_id"),
        F.trim(F.regexp_replace(F.col("explanation").cast("string"), r"[\r\n]", " ")).alias("explanation"))


def write_explanations(explanations: DataFrame, path: str) -> None:
    """CSV files as analysts receive them, one per writer task."""
    (explanations_csv(explanations).write.mode("overwrite")
        .option("header", True).option("quoteAll", True).option("escape", '"').csv(path))


# Batch results: the rows, a folder per batch, and a ledger of the batches
# whose rows are complete. Rows are written first and replace what an ended run
# left of their batch; the ledger entry comes last, and only batches in the
# ledger are read. So a batch counts once, wherever a run ends.

def _ledger(spark: SparkSession, done_path: str) -> DataFrame:
    path = f"{done_path.rstrip('/')}/ledger"
    if not path_exists(spark, path):
        return spark.createDataFrame([], "batch_id int")
    return spark.read.schema("batch_id int").parquet(path).distinct()


def pending_batches(spark: SparkSession, requests: DataFrame, done_path: str) -> DataFrame:
    """Requests whose batch is not in the ledger, so a re-run resumes where the
    last one stopped."""
    return requests.join(_ledger(spark, done_path), "batch_id", "left_anti")


def write_batch_rows(results: DataFrame, done_path: str) -> None:
    """Rows of some batches, in place of any that those batches have."""
    (results.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id")
            .parquet(f"{done_path.rstrip('/')}/rows"))


def append_batch_results(results: DataFrame, done_path: str) -> None:
    """Finish batches: their rows, then their entries in the ledger."""
    results = write_stage_table(results, "batch-results")  # rows and ledger from one computation
    write_batch_rows(results, done_path)
    batches = results.select(F.col("batch_id").cast("int").alias("batch_id")).distinct()
    batches.coalesce(1).write.mode("append").parquet(f"{done_path.rstrip('/')}/ledger")


def finished_batches(spark: SparkSession, done_path: str) -> DataFrame:
    """The rows of all batches in the ledger."""
    rows = spark.read.parquet(f"{done_path.rstrip('/')}/rows")
    return rows.join(_ledger(spark, done_path), "batch_id", "left_semi")
