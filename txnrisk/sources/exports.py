"""Real exports: a folder of CSV files, read with explicit schemas, with the
records that do not fit them set aside.

A file is read whole, whatever columns a later step needs: a record is
malformed if any of its values cannot be read as its type, or if it has too
few or too many fields. Such records go to a table of their own as text, and
the others go on. Times and codes are read as text, as a bad one is no reason
to lose a record: they become NULL later.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import CHANNELS
from ..session import write_stage_table
from .channels import CHANNEL_SCHEMA, path_exists


def _schema(text: str) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in (
        (part.split()[0], {"long": T.LongType(), "double": T.DoubleType(), "date": T.DateType(), "int": T.IntegerType(),
                           "string": T.StringType()}[part.split()[1]]) for part in text.split(", "))])


# FIXED VALUES: the columns of the exports beside the channels
KYC_INDIVIDUAL = _schema("customer_id long, income double, occupation_code string, birth_date string, onboard_date string")
KYC_BUSINESS = _schema("customer_id long, sales double, industry_code string, employee_count double, established_date string")
OCCUPATION_CODES = _schema("occupation_code string, occupation_title string")
INDUSTRY_CODES = _schema("industry_code string, industry string")
LABELS = _schema("customer_id long, label int")
TABLES = {"kyc_individual": KYC_INDIVIDUAL, "kyc_smallbusiness": KYC_BUSINESS, "kyc_occupation_codes": OCCUPATION_CODES,
          "kyc_industry_codes": INDUSTRY_CODES, "labels": LABELS}
REJECT = "_rejected_record"


def read_export(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(good records, rejected records as ``record`` text) of a CSV file or
    folder. Columns are matched by the header; of ``schema``, those that the
    header has; others stay text."""
    first = spark.read.option("header", True).csv(path).columns  # header line only
    known = {f.name: f for f in schema.fields}
    fields = [known.get(h, T.StructField(h, T.StringType())) for h in first]
    parsed = (spark.read.schema(T.StructType([*fields, T.StructField(REJECT, T.StringType())]))
                   .option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE")
                   .option("escape", '"').option("multiLine", True)  # as quoted by the writers of such files
                   .option("columnPruning", False).option("columnNameOfCorruptRecord", REJECT).csv(path))
    # parsed once: a pruned scan would judge records by the columns it keeps
    parsed = write_stage_table(parsed.withColumn("is_rejected", F.col(REJECT).isNotNull()), "export", ["is_rejected"])
    good = parsed.where(~F.col("is_rejected")).drop(REJECT, "is_rejected")
    return good, parsed.where("is_rejected").select(F.col(REJECT).alias("record"))


@dataclass
class Exports:
    """``channels``: per channel present; ``tables``: by the name of the file;
    ``rejects``: (source, record) of all files."""

    channels: dict[str, DataFrame]
    tables: dict[str, DataFrame]
    rejects: DataFrame


def read_exports(spark: SparkSession, directory: str) -> Exports:
    """All files ``<channel>.csv`` that exist (at least one) and the five
    others, of which labels may be missing."""
    base = directory.rstrip("/")
    channels, tables = {}, {}
    rejects = spark.createDataFrame([], "source string, record string")
    wanted = [(ch, ch.lower(), CHANNEL_SCHEMA, channels) for ch in CHANNELS]
    wanted += [(name, name, schema, tables) for name, schema in TABLES.items()]
    for key, file, schema, into in wanted:
        path = f"{base}/{file}.csv"
        if not path_exists(spark, path):
            if into is tables and key != "labels":
                raise FileNotFoundError(path)
            continue
        into[key], bad = read_export(spark, path, schema)
        rejects = rejects.unionByName(bad.select(F.lit(key).alias("source"), "record"))
    if not channels:
        raise FileNotFoundError(f"no channel table found under {directory}")
    if "labels" not in tables:
        tables["labels"] = spark.createDataFrame([], LABELS)
    return Exports(channels, tables, rejects)


def dated(kyc: DataFrame, *columns: str) -> DataFrame:
    """Text columns as dates; what is no date is NULL."""
    return kyc.withColumns({c: F.expr(f"try_cast(`{c}` AS date)") for c in columns if c in kyc.columns})
