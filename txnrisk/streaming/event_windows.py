"""Stateful streams over the landed transactions: daily flow windows, the rows
that came too late for them, and structuring alerts while the stream runs.

A daily window is held in the state store until the watermark (the latest
event time seen less ``delay``) passes its end; it leaves then, once, and rows
that come for it later are dropped by Spark. What was dropped is the
difference between the arrivals (``daily_flow``, which keeps every row) and
the windows that left.

Alerts count amounts just under the reporting threshold in sliding windows of
24 hours. Windows that overlap hold the same burst, so an alert is known by
its customer and the first amount of its window, and
``dropDuplicatesWithinWatermark`` lets each leave once - across restarts too,
as that state is in the checkpoint.

State and sinks lie in the folders given, which all executors share. The state
grows with the customers active within ``delay``, not with the stream's
length; a cluster sets the RocksDB state store where that exceeds memory.
Event times are wall-clock times as UTC instants (``land``), so windows start
at midnight whatever the session's zone.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from .daily_flow import SUMS, TXN_STREAM_SCHEMA, flow_sums, utc_day


def _source(spark: SparkSession, source_dir: str, files_per_trigger: int, delay: str) -> DataFrame:
    return (spark.readStream.schema(TXN_STREAM_SCHEMA).option("maxFilesPerTrigger", files_per_trigger)
                 .parquet(source_dir).withWatermark("transaction_datetime", delay))


def _run(out: DataFrame, sink_dir: str, checkpoint_dir: str) -> None:
    q = (out.writeStream.format("parquet").option("path", sink_dir).option("checkpointLocation", checkpoint_dir)
            .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()


def run_daily_windows(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str, delay: str,
                      files_per_trigger: int = 64) -> None:
    """Take in what ``source_dir`` has; windows that the watermark passed leave."""
    windows = (_source(spark, source_dir, files_per_trigger, delay)
               .groupBy("customer_id", F.window("transaction_datetime", "1 day").alias("w")).agg(*flow_sums()))
    _run(windows.select("customer_id", utc_day(F.col("w.start")).alias("day"), *SUMS), sink_dir, checkpoint_dir)


def run_alerts(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str, delay: str = "2 days",
               least: int = 3, slide: str = "6 hours", files_per_trigger: int = 64) -> None:
    """Customers with ``least`` or more amounts just under the threshold within
    24 hours: the first and the last of them. Windows slide by ``slide``;
    ``delay`` is to be 24 hours at least, or overlapping windows would repeat."""
    amt = F.col("amount_cad")
    near = _source(spark, source_dir, files_per_trigger, delay).where(
        (amt >= K.NEAR_THRESHOLD_LOW) & (amt < K.REPORTING_THRESHOLD))
    per = near.groupBy("customer_id", F.window("transaction_datetime", "24 hours", slide).alias("w")).agg(
        F.count(F.lit(1)).alias("n"), F.min("transaction_datetime").alias("first_time"))
    alerts = (per.where(F.col("n") >= least).select("customer_id", "first_time", F.window_time("w").alias("at"))
                 .dropDuplicatesWithinWatermark(["customer_id", "first_time"]))
    _run(alerts.select("customer_id", "first_time"), sink_dir, checkpoint_dir)


def close_stream(spark: SparkSession, source_dir: str, until: datetime) -> None:
    """Land a row of no customer at ``until``, as a feed's heartbeat: a
    watermark moves with rows only, and the last windows wait for it."""
    beat = [(None, float(K.NEAR_THRESHOLD_LOW), None, until.replace(tzinfo=timezone.utc), None)]
    spark.createDataFrame(beat, TXN_STREAM_SCHEMA).coalesce(1).write.mode("append").parquet(source_dir)


def read_sink(spark: SparkSession, sink_dir: str) -> DataFrame:
    """What has left the stream, without the heartbeats."""
    return spark.read.parquet(sink_dir).where("customer_id is not null")


def late_rows(arrivals: DataFrame, windows: DataFrame) -> DataFrame:
    """Per (customer, day) the rows that arrived but are in no window. To be
    asked when the windows of the arrivals have left."""
    sums = ["n_txn", "volume"]
    both = arrivals.select("customer_id", "day", *sums).unionAll(
        windows.select("customer_id", "day", *[(-F.col(c)).alias(c) for c in sums]))
    left = both.groupBy("customer_id", "day").agg(F.sum("n_txn").alias("n_late"), F.sum("volume").alias("late_volume"))
    return left.where("n_late > 0")
