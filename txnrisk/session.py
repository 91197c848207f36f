"""Spark session, shared-storage helpers and stage tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job in the package relies on. ANSI mode stays on (Spark 4
# default); operators guard divisions with try_divide / nullif themselves.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int = 8, app: str = "txnrisk") -> SparkSession:
    """Local session for tests and benches. On a cluster, spark-submit owns
    master and sizing; this only fills in what is unset."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", os.environ.get("TXNRISK_DRIVER_MEMORY", "16g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The cluster names it in ``spark.checkpoint.dir``. Only a session in one
    JVM may do without: there a fresh scratch folder is shared by definition."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="txnrisk-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def shared_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def write_stage_table(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a stage output as parquet under the shared checkpoint folder and
    read it back: later stages scan it with column pruning, filter and
    partition pushdown instead of recomputing its lineage."""
    path = shared_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_customer_table(df: DataFrame, name: str) -> DataFrame:
    """Write a customer-level stage output bucketed and sorted by
    ``customer_id``, one file per bucket, and read it back: joins of such
    tables on the customer shuffle neither side."""
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions", "8"))
    table = f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    (df.repartition(buckets, "customer_id").write.bucketBy(buckets, "customer_id").sortBy("customer_id")
       .option("path", shared_path(spark, table)).saveAsTable(table))
    return spark.read.table(table)
