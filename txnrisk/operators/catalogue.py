"""Indicator catalogue and MCC lookups, joined to what actually fired.

The catalogue (44 rows) and the indicator->MCC map (about 150 pairs) are fixed
reference tables, so broadcasting them is bounded by construction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from .rules import indicator_column_name, indicator_ids

CATALOGUE_SCHEMA = T.StructType([
    T.StructField("indicator_id", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("sub_category", T.StringType()),
    T.StructField("risk_level", T.StringType()),
    T.StructField("typology", T.StringType()),
    T.StructField("transaction_types", T.StringType()),
    T.StructField("co_occurring", T.StringType()),
])


def catalogue(spark: SparkSession) -> DataFrame:
    df = spark.createDataFrame(K.CATALOGUE, CATALOGUE_SCHEMA)
    return (df.withColumn("transaction_types", F.split(F.col("transaction_types"), r",\s*"))
              .withColumn("co_occurring", F.split(F.col("co_occurring"), r",\s*")))


def read_catalogue_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read the indicator catalogue export: strip the byte-order mark from the
    first header, drop typology banner rows (no description), split the comma
    lists into arrays."""
    raw = (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
           .csv(path))
    first = raw.columns[0]
    raw = raw.withColumnRenamed(first, first.lstrip("﻿"))
    rename = {c: c.strip().lower().replace(" ", "_") for c in raw.columns}
    for a, b in rename.items():
        raw = raw.withColumnRenamed(a, b)
    keep = raw.where(F.col("red_flag_description").isNotNull() & (F.trim("red_flag_description") != ""))
    return (keep.withColumn("transaction_type", F.split(F.col("transaction_type"), r",\s*"))
                .withColumn("co_occurring_indicators", F.split(F.col("co_occurring_indicators"), r",\s*")))


def write_catalogue_csv(spark: SparkSession, path: str) -> None:
    """The catalogue as an export of its own, in the columns and the form that
    ``read_catalogue_csv`` expects: a byte-order mark, and a banner row before
    the indicators of each typology. One file, as the catalogue is 44 rows."""
    header = ["Indicator Id", "Red Flag Description", "Risk Level", "Transaction Type", "Co Occurring Indicators"]
    df = spark.createDataFrame(K.CATALOGUE, CATALOGUE_SCHEMA)
    described = F.concat_ws(" - ", "category", "sub_category")
    record = F.to_csv(F.struct("indicator_id", described, "risk_level", "transaction_types", "co_occurring"), {"escape": '"'})
    rows = df.select("typology", F.lit(1).alias("kind"), "indicator_id", record.alias("value"))
    banners = df.groupBy("typology").agg(F.count(F.lit(1)).alias("n")).select(
        "typology", F.lit(0).alias("kind"), F.lit("").alias("indicator_id"),
        F.concat(F.lit("  ▌ "), F.upper("typology"), F.lit("   ("), F.col("n"), F.lit(" indicators),,,,")).alias("value"))
    top = spark.createDataFrame([("", 0, "", "\ufeff" + ",".join(header))], "typology string, kind int, indicator_id string, value string")
    (top.unionByName(banners).unionByName(rows).coalesce(1).sortWithinPartitions("typology", "kind", "indicator_id")
        .select("value").write.mode("overwrite").text(path))


def cooccurrence_edges(cat: DataFrame) -> DataFrame:
    """Directed catalogue edges (src -> dst) with reverse / dangling flags."""
    e = cat.select(F.col("indicator_id").alias("src"), F.explode("co_occurring").alias("dst"))
    rev = e.select(F.col("dst").alias("src"), F.col("src").alias("dst")).withColumn("has_reverse", F.lit(1))
    ids = cat.select(F.col("indicator_id").alias("dst")).withColumn("dst_in_catalogue", F.lit(1))
    return (e.join(rev, ["src", "dst"], "left").join(ids, "dst", "left")
             .select("src", "dst", F.coalesce("has_reverse", F.lit(0)).alias("has_reverse"),
                     F.coalesce("dst_in_catalogue", F.lit(0)).alias("dst_in_catalogue")))


def fired_indicators(points: DataFrame) -> DataFrame:
    """(customer_id, indicator_id) for every indicator with points > 0."""
    items = [F.struct(F.lit(ind).alias("indicator_id"),
                      F.col(f"`{indicator_column_name(t, ind)}`").alias("points"))
             for _, t, ind in indicator_ids()]
    return (points.select("customer_id", F.explode(F.array(*items)).alias("x"))
                  .where(F.col("x.points") > 0).select("customer_id", "x.indicator_id"))


def trace_pairs(trace_items: DataFrame, items_col: str = "rule_indicator_trace_items") -> DataFrame:
    """Unordered indicator pairs inside each customer's trace (at most 5
    items, so at most 10 pairs per customer), built inside the array."""
    arr = F.col(items_col)
    pairs = F.flatten(F.transform(arr, lambda x, i: F.transform(
        F.slice(arr, i + 2, 5), lambda y: F.struct(F.least(x["ind"], y["ind"]).alias("ind_a"),
                                                   F.greatest(x["ind"], y["ind"]).alias("ind_b")))))
    return trace_items.select("customer_id", F.explode(pairs).alias("p")).select("customer_id", "p.*")


def indicator_mcc(spark: SparkSession) -> DataFrame:
    rows = [(ind, str(m)) for ind, codes in K.INDICATOR_MCC.items() for m in codes]
    return spark.createDataFrame(rows, "indicator_id string, mcc string")


BIN = 100


def mcc_intervals(spark: SparkSession) -> DataFrame:
    """(low, high, description): one interval per code, wider for the codes
    that open a range."""
    rows = [(code, K.MCC_RANGES.get(code, code), text) for code, text in K.MCC_DESCRIPTIONS.items()]
    return spark.createDataFrame(rows, "low int, high int, description string")


def with_mcc_description(df: DataFrame, intervals: DataFrame, code: str = "mcc") -> DataFrame:
    """``df`` with the ``description`` of its merchant category code (text):
    that of the narrowest interval around it; NULL outside all and for codes
    that are no numbers.

    A range join as an equi-join: an interval stands in every bin of codes that
    it meets, and a code looks in its own. The codes are described once each,
    before they meet the rows."""
    number = F.expr(f"try_cast(`{code}` AS int)")
    first, last = F.floor(F.col("low") / BIN), F.floor(F.col("high") / BIN)
    binned = intervals.withColumn("bin", F.explode(F.sequence(first, last)))
    codes = df.select(F.col(code), number.alias("number")).where("number IS NOT NULL").distinct()
    described = (codes.withColumn("bin", F.floor(F.col("number") / BIN)).join(binned, "bin")
                      .where((F.col("number") >= F.col("low")) & (F.col("number") <= F.col("high")))
                      .groupBy(code).agg(F.min_by("description", F.struct(F.col("high") - F.col("low"), "low")).alias("description")))
    return df.join(F.broadcast(described), code, "left")  # codes of four digits: at most 10,000 rows
