"""Channel sources, the unified transaction table, and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import CHANNELS

# Explicit schema for channel exports (CSV is never schema-inferred).
CHANNEL_SCHEMA = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("amount_cad", T.DoubleType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("debit_credit", T.StringType()),
    T.StructField("transaction_datetime", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("province", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("merchant_category", T.StringType()),
    T.StructField("ecommerce_ind", T.IntegerType()),
    T.StructField("cash_indicator", T.IntegerType()),
])

UNIFIED_TYPES = {
    "customer_id": "long",
    "amount_cad": "double",
    "debit_credit": "string",
    "transaction_datetime": "timestamp_ntz",
    "country": "string",
    "province": "string",
    "city": "string",
    "merchant_category": "string",
    "ecommerce_ind": "int",
    "cash_indicator": "int",
    "channel": "string",
}


def read_channel_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read one channel export. Only the columns present in the header are
    kept; unknown timestamps stay text until ``unify_transactions``."""
    header = spark.read.option("header", True).csv(path).columns  # header line only
    known = {f.name: f for f in CHANNEL_SCHEMA.fields}
    # schema in the file's own column order; unknown columns stay text
    schema = T.StructType([known.get(h, T.StructField(h, T.StringType())) for h in header])
    return (spark.read.schema(schema).option("header", True)
            .option("enforceSchema", False).option("mode", "PERMISSIVE").csv(path))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of the path (HDFS, S3,
    local), as the cluster sees it."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_channel_dir(spark: SparkSession, directory: str, fmt: str = "csv") -> dict[str, DataFrame]:
    """Read every channel file that exists (``abm.csv``, ``card.csv`` ...).
    A missing channel is skipped; no channel at all is an error."""
    out = {}
    for ch in CHANNELS:
        path = f"{directory.rstrip('/')}/{ch.lower()}.{fmt}"
        if not path_exists(spark, path):
            continue
        out[ch] = read_channel_csv(spark, path) if fmt == "csv" else spark.read.parquet(path)
    if not out:
        raise FileNotFoundError(f"no channel table found under {directory}")
    return out


def unify_transactions(channels: dict[str, DataFrame]) -> DataFrame:
    """Union of all channel tables with the channel tag, ``amount`` renamed to
    ``amount_cad``, and the required columns padded with typed NULLs."""
    if not channels:
        raise ValueError("no channel tables to unify")
    frames = []
    for ch, df in channels.items():
        if "amount_cad" not in df.columns and "amount" in df.columns:
            df = df.withColumnRenamed("amount", "amount_cad")
        elif "amount" in df.columns:
            df = df.drop("amount")
        cols = []
        for name, typ in UNIFIED_TYPES.items():
            if name == "channel":
                cols.append(F.lit(ch).alias("channel"))
            elif name in df.columns:
                c = F.col(name)
                if name == "transaction_datetime":
                    c = F.try_to_timestamp(c.cast("string")).cast("timestamp_ntz") \
                        if dict(df.dtypes)[name] == "string" else c.cast("timestamp_ntz")
                else:
                    c = c.cast(typ)
                cols.append(c.alias(name))
            else:
                cols.append(F.lit(None).cast(typ).alias(name))
        frames.append(df.select(*cols))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def with_time_columns(txn: DataFrame) -> DataFrame:
    """hour, day_of_week (Monday = 0), year_month ('NaT' for unparsable
    timestamps, which then form their own month bucket) and date."""
    ts = F.col("transaction_datetime")
    return (txn.withColumn("hour", F.hour(ts))
               .withColumn("day_of_week", F.weekday(ts))
               .withColumn("year_month", F.coalesce(F.date_format(ts, "yyyy-MM"), F.lit("NaT")))
               .withColumn("date", F.to_date(ts)))


def clean_transactions(txn: DataFrame) -> DataFrame:
    """Rows without a customer cannot be grouped and are dropped."""
    return txn.where(F.col("customer_id").isNotNull())


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).option("escape", '"').csv(path)
    else:
        w.format(fmt).save(path)


def write_channel_csvs(channels: dict[str, DataFrame], directory: str) -> None:
    """One CSV export per channel (``<channel>.csv`` folders), header + quoted
    text, as the bank exports arrive."""
    for ch, df in channels.items():
        (df.write.mode("overwrite").option("header", True).option("escape", '"')
           .csv(f"{directory.rstrip('/')}/{ch.lower()}.csv"))
