"""Customer analyses beside the feature table: entropy of the transaction
hour, average retail purchase, a customer's volume against its city's, hotel
stays followed by cash in the same city, and turnover within a day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from .features import mcc_code


def hour_entropy(txn: DataFrame) -> DataFrame:
    """Shannon entropy (nats) of the hour of a customer's transactions; 24
    counts per customer at most after the first aggregate."""
    per = txn.where("hour is not null").groupBy("customer_id", "hour").agg(F.count(F.lit(1)).alias("n"))
    # -sum(n/t ln(n/t)) = ln t - sum(n ln n) / t
    s = per.groupBy("customer_id").agg(F.sum("n").alias("n_rows"), F.sum(F.col("n") * F.ln("n")).alias("s"))
    return s.select("customer_id", "n_rows", F.greatest(
        F.ln("n_rows") - F.col("s") / F.col("n_rows"), F.lit(0.0)).alias("hour_entropy_score"))


def card_retail_avg(txn: DataFrame) -> DataFrame:
    """Number and average amount of card purchases in retail categories."""
    card = txn.where("channel = 'Card'").withColumn("mcc", mcc_code()).where(F.col("mcc").isin(K.MCC_RETAIL))
    return card.groupBy("customer_id").agg(F.count("amount_cad").alias("n_retail"),
                                           F.avg("amount_cad").alias("avg_retail_amount"))


def geo_volume_z(txn: DataFrame) -> DataFrame:
    """A customer's volume in a city as a z-score among the city's customers
    (NULL for a city with one customer or no spread)."""
    per = txn.where("city is not null").groupBy("customer_id", "city").agg(F.sum("amount_cad").alias("volume"))
    city = per.groupBy("city").agg(F.avg("volume").alias("mean"), F.stddev_samp("volume").alias("sd"))
    return per.join(city, "city").select("customer_id", "city", "volume", F.try_divide(
        F.col("volume") - F.col("mean"), F.col("sd")).alias("volume_score"))


def _city_days(txn: DataFrame, name: str) -> DataFrame:
    return txn.where("city is not null and date is not null").groupBy("customer_id", "city", "date").agg(
        F.count(F.lit(1)).alias(f"n_{name}"), F.sum("amount_cad").alias(f"{name}_amount"))


def hotel_cash_match(txn: DataFrame) -> DataFrame:
    """Card spending on accommodation and cash-machine use by the same
    customer in the same city on the same or the next day: both sides are
    daily sums, so the join is on equal keys."""
    hotel = txn.where("channel = 'Card'").withColumn("mcc", mcc_code()).where(F.col("mcc").isin(K.MCC_ACCOMMODATION))
    hotel = _city_days(hotel, "hotel").withColumn("cash_date", F.explode(F.array("date", F.date_add("date", 1))))
    cash = _city_days(txn.where("channel = 'ABM'"), "cash").withColumnRenamed("date", "cash_date")
    return hotel.join(cash, ["customer_id", "city", "cash_date"]).select(
        "customer_id", "city", "date", "cash_date", "n_hotel", "hotel_amount", "n_cash", "cash_amount")


def same_day_turnover(txn: DataFrame) -> DataFrame:
    """Per customer and time of credits: the credit, the debits that follow it
    within 24 hours (number, sum) and the smaller of the two amounts (money that
    may have passed through). A debit belongs to the latest credit not after it,
    so it is used once; a credit at the same time comes before it.

    The latest credit within 24 hours lies in the debit's day of 86,400 seconds
    or the day before. Windows are therefore per customer and day, with the last
    credit of the day before carried over: a customer with most rows is spread
    over its days."""
    amt, at = F.col("amount_cad"), F.col("transaction_datetime")
    event = (txn.where(at.isNotNull() & (amt > 0) & F.col("debit_credit").isin("C", "D"))
                .groupBy("customer_id", "transaction_datetime")
                .agg(F.sum(F.when(F.col("debit_credit") == "C", amt)).alias("credit"),
                     F.sum(F.when(F.col("debit_credit") == "D", amt)).alias("debit"),
                     F.count(F.when(F.col("debit_credit") == "D", 1)).alias("n"))
                .withColumn("day", F.unix_date(F.to_date("transaction_datetime"))))
    credit_at = F.when(F.col("credit").isNotNull(), at)
    carried = (event.where("credit is not null").groupBy("customer_id", (F.col("day") + 1).alias("day"))
                    .agg(F.max("transaction_datetime").alias("carried")))
    so_far = Window.partitionBy("customer_id", "day").orderBy("transaction_datetime")
    tied = event.join(carried, ["customer_id", "day"], "left").withColumn(
        "credit_at", F.coalesce(F.max(credit_at).over(so_far), F.col("carried")))
    within = at <= F.col("credit_at") + F.make_dt_interval(hours=F.lit(24))
    return (tied.where(within & (F.col("n") > 0) | F.col("credit").isNotNull())
                .groupBy("customer_id", F.col("credit_at").alias("transaction_datetime"))
                .agg(F.max(F.when(at == F.col("credit_at"), F.col("credit"))).alias("credit"),
                     F.sum("n").alias("n_debits"), F.coalesce(F.sum("debit"), F.lit(0.0)).alias("debit_24h"))
                .withColumn("turnover", F.least("credit", "debit_24h")))
