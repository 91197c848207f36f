"""Bank-style inputs derived from the driver's TPC-H-like tables.

The studied pipeline reads private bank exports; our test and bench inputs are
derived, deterministically, from `lineitem`, `orders` and `customer` (see
FIXTURES.md part 3). Ten TPC-H customers fold into one bank customer so each
bank customer has a few hundred transactions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import CHANNELS


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(key: Column, mapping: list[tuple[int, object]], default=None) -> Column:
    expr = None
    for k, v in mapping:
        expr = F.when(key == k, F.lit(v)) if expr is None else expr.when(key == k, F.lit(v))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def fixture_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unified transaction table (all channels), before derived time columns.

    lineitem ⋈ orders on the order key: a shuffle join on both sides at scale
    (no broadcast: both sides grow with the data), by hash, as two narrow
    columns of the orders of a partition are small and need no sorted lines."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_linestatus")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").hint("shuffle_hash")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")

    cid = F.floor(F.col("o_custkey") / 10).cast("long")
    j = j.withColumn("customer_id", cid) \
         .withColumn("prof", F.col("customer_id") % 6) \
         .withColumn("k", F.col("l_orderkey") * 7 + F.col("l_linenumber") * 3 + F.col("l_partkey"))

    prof, k, pk = F.col("prof"), F.col("k"), F.col("l_partkey")
    by_supp = _case(F.col("l_suppkey") % 7, list(enumerate(CHANNELS)))
    channel = F.when((prof == 5) & (k % 3 < 2), F.lit("Wire")).otherwise(by_supp)

    day = (F.when(prof == 1, k % 12)
            .when(prof == 2, k % 20 + F.when(k % 2 == 0, F.lit(220)).otherwise(F.lit(0)))
            .otherwise(k % 300))
    hour = F.when((prof == 3) & (k % 4 < 3), F.lit(23)).otherwise((k * 5) % 24)
    ts = F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)) + \
        F.make_dt_interval(day.cast("int"), hour.cast("int"), (pk % 60).cast("int"), F.lit(0))

    price = F.col("l_extendedprice")
    divisor = F.when(F.col("channel") == "ABM", F.lit(10.0)) \
               .when(F.col("channel") == "Card", F.lit(100.0)).otherwise(F.lit(4.0))
    amount = (F.when((k % 11 == 0) | ((prof == 4) & (k % 10 < 8)),
                     F.floor(price / 4000).cast("double") * 1000.0)
               .when(k % 7 == 0, F.floor(price / 400).cast("double") * 100.0)
               .otherwise(price / divisor))

    is_card = F.col("channel") == "Card"
    country = F.when(~is_card, F.lit(None).cast("string")) \
        .when(pk % 5 < 3, F.lit("CA")) \
        .otherwise(_case(pk % 25, [(3, "IR"), (4, "MX"), (8, "CN"), (9, "KY"), (13, "PA")], "US"))
    mcc = _case(F.col("l_quantity").cast("int") % 10,
                [(0, "5411"), (1, "5944"), (2, "7523"), (3, "5814"), (4, "4816"),
                 (5, "7011"), (6, "3005"), (7, "7297")], "5541")

    return (j.withColumn("channel", channel)
             .select(
                 "customer_id",
                 amount.alias("amount_cad"),
                 F.when(F.col("l_linestatus") == "F", F.lit("D")).otherwise(F.lit("C")).alias("debit_credit"),
                 ts.alias("transaction_datetime"),
                 country.alias("country"),
                 F.concat(F.lit("prov"), (pk % (F.lit(1) + prof % 3)).cast("string")).alias("province"),
                 F.concat(F.lit("city"), (pk % (F.lit(1) + prof * 2)).cast("string")).alias("city"),
                 F.when(is_card, mcc).alias("merchant_category"),
                 F.when(is_card, F.when(pk % 3 == 0, F.lit(1)).otherwise(F.lit(0))).alias("ecommerce_ind"),
                 F.when(F.col("channel") == "ABM", (pk % 2).cast("int")).alias("cash_indicator"),
                 "channel",
             ))


def split_channels(t: DataFrame) -> dict[str, DataFrame]:
    """Split a unified table back into per-channel exports."""
    base = ["customer_id", "amount_cad", "debit_credit", "transaction_datetime", "province", "city"]
    out = {}
    for ch in CHANNELS:
        part = t.filter(F.col("channel") == ch)
        if ch == "Card":
            cols = base + ["country", "merchant_category", "ecommerce_ind"]
            out[ch] = part.select(*cols)
        elif ch == "ABM":
            out[ch] = part.select(*base, "cash_indicator").withColumnRenamed("amount_cad", "amount")
        else:
            out[ch] = part.select(*base)
    return out


def _kyc_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One KYC customer per ten rows of ``customer`` (orders fold the same
    way), with the largest balance of the ten."""
    c = read_table(spark, sf_dir, "customer")
    return (c.groupBy(F.floor(F.col("c_custkey") / 10).cast("long").alias("customer_id"))
             .agg(F.max("c_acctbal").alias("c_acctbal")))


def fixture_kyc_individual(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _kyc_base(spark, sf_dir)
    cid = F.col("customer_id")
    return (b.filter(cid % 4 < 3).select(
        "customer_id",
        ((F.lit(20000.0) + F.abs(F.col("c_acctbal")) * 10) * (F.lit(1) + (cid % 10) * 10)).alias("income"),
        _case(cid % 5, [(0, 41101), (1, 63101), (2, 12345), (3, 70010)]).cast("int").alias("occupation_code"),
        F.date_add(F.lit("1950-01-01").cast("date"), ((cid * 37) % 18000).cast("int")).alias("birth_date"),
        F.date_add(F.lit("2023-01-01").cast("date"), ((cid * 11) % 700).cast("int")).alias("onboard_date"),
    ))


def fixture_kyc_business(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _kyc_base(spark, sf_dir)
    cid = F.col("customer_id")
    return (b.filter(cid % 4 == 3).select(
        "customer_id",
        ((F.lit(50000.0) + F.abs(F.col("c_acctbal")) * 100) * (F.lit(1) + (cid % 5) * 4)).alias("sales"),
        _case(cid % 5, [(0, 6561), (1, 9111), (2, 1000), (3, 7611), (4, 2000)]).cast("int").alias("industry_code"),
        (cid % 15).cast("double").alias("employee_count"),
        F.date_format(F.date_add(F.lit("2000-01-01").cast("date"), ((cid * 53) % 7000).cast("int")),
                      "yyyy-MM-dd").alias("established_date"),
    ))


def fixture_occupation_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code table: one row per occupation code seen in KYC (a code table grows
    with the KYC population, so it is derived, not listed)."""
    k = fixture_kyc_individual(spark, sf_dir)
    return (k.select("occupation_code").where(F.col("occupation_code").isNotNull()).distinct()
             .select(F.col("occupation_code").cast("string").alias("occupation_code"),
                     F.concat(F.lit("occupation "), F.col("occupation_code").cast("string")).alias("occupation_title")))


def fixture_industry_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = fixture_kyc_business(spark, sf_dir)
    return (k.select("industry_code").where(F.col("industry_code").isNotNull()).distinct()
             .select(F.col("industry_code").cast("string").alias("industry_code"),
                     F.concat(F.lit("industry "), F.col("industry_code").cast("string")).alias("industry")))


def fixture_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse labels: 1 suspicious, 0 cleared, absent = unknown."""
    b = _kyc_base(spark, sf_dir)
    cid = F.col("customer_id")
    label = (F.when(((cid % 6).isin(1, 3, 4)) & (cid % 5 == 0), F.lit(1))
              .when(cid % 3 == 0, F.lit(0)))
    return b.select("customer_id", label.cast("int").alias("label")).where(F.col("label").isNotNull())


AS_OF = "2024-12-31"
