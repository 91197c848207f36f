"""Arrivals: incremental per-customer daily flow and structuring counts on
Structured Streaming, without state (``event_windows`` has the stateful form).

The same aggregates the batch feature job computes per customer (volume,
inflow / outflow, sub-threshold and near-threshold counts) per (customer,
day), as transactions land. All of them are sums, so a micro-batch writes the
partial sums of its own rows and the reader adds them up: no state is held
between batches, and no row is ever too late - the result does not depend on
the order of files or on how many a trigger takes. Each micro-batch owns one
folder of the sink and overwrites it, so a batch that is repeated after a
failure counts once. Checkpoint and sink live in the shared folder, so a
restarted query resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K

TXN_STREAM_SCHEMA = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("amount_cad", T.DoubleType()),
    T.StructField("debit_credit", T.StringType()),
    T.StructField("transaction_datetime", T.TimestampType()),
    T.StructField("channel", T.StringType()),
])
SUMS = ["n_txn", "volume", "inflow", "outflow", "count_below_10k", "count_near_10k"]


def wall_clock(time: Column) -> Column:
    """A time without zone as the instant at which UTC clocks show it."""
    seconds = F.unix_date(F.to_date(time)).cast("long") * 86400 + F.hour(time) * 3600 + F.minute(time) * 60
    return F.timestamp_micros(seconds * 1_000_000 + (F.date_part(F.lit("SECOND"), time) * 1_000_000).cast("long"))


def utc_wall(instant: Column) -> Column:
    """The time without zone that UTC clocks show at an instant."""
    epoch = F.make_timestamp_ntz(F.lit(1970), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    return epoch + F.make_dt_interval(secs=(F.unix_micros(instant) / 1_000_000).cast("decimal(18,6)"))


def utc_day(instant: Column) -> Column:
    return F.date_from_unix_date(F.floor(F.unix_seconds(instant) / 86400).cast("int"))


def flow_sums() -> list[Column]:
    amt = F.col("amount_cad")
    below = amt < K.REPORTING_THRESHOLD
    return [F.count(F.lit(1)).alias("n_txn"),
            F.coalesce(F.sum(amt), F.lit(0.0)).alias("volume"),
            F.coalesce(F.sum(F.when(F.col("debit_credit") == "C", amt)), F.lit(0.0)).alias("inflow"),
            F.coalesce(F.sum(F.when(F.col("debit_credit") == "D", amt)), F.lit(0.0)).alias("outflow"),
            F.count(F.when(below, amt)).alias("count_below_10k"),
            F.count(F.when((amt >= K.NEAR_THRESHOLD_LOW) & below, 1)).alias("count_near_10k")]


def daily_flow(rows: DataFrame) -> DataFrame:
    """Sums per (customer, day); rows without a customer or a time have none."""
    return (rows.where(F.col("customer_id").isNotNull() & F.col("transaction_datetime").isNotNull())
                .groupBy("customer_id", utc_day(F.col("transaction_datetime")).alias("day")).agg(*flow_sums()))


def run_daily_flow(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str,
                   files_per_trigger: int = 8) -> None:
    """Process everything available in ``source_dir`` and stop."""
    src = (spark.readStream.schema(TXN_STREAM_SCHEMA).option("maxFilesPerTrigger", files_per_trigger)
                .parquet(source_dir))

    def write(batch: DataFrame, epoch: int) -> None:
        daily_flow(batch).write.mode("overwrite").parquet(f"{sink_dir.rstrip('/')}/epoch={epoch}")

    q = (src.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_dir)
            .trigger(availableNow=True).start())
    q.awaitTermination()


def windows(spark: SparkSession, sink_dir: str) -> DataFrame:
    """Every (customer, day) window: the sums over all micro-batches."""
    t = spark.read.parquet(sink_dir)
    return t.groupBy("customer_id", "day").agg(*[F.sum(c).alias(c) for c in SUMS])


def land(txn: DataFrame, source_dir: str) -> None:
    """Land transactions in the source folder, as an upstream feed would."""
    cols = [(wall_clock(F.col(f.name)) if f.name == "transaction_datetime" else F.col(f.name).cast(f.dataType)).alias(f.name)
            for f in TXN_STREAM_SCHEMA.fields]
    txn.select(*cols).write.mode("append").parquet(source_dir)
