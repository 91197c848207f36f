"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path

# FIXED VALUES: very common words of English, French, German and Spanish
COMMON_WORDS = sorted(set((
    "the of and to in a is that for it was on are as with at by this from or an be have not but they which "
    "la le de les et des une un est que qui pour dans en au sur avec par pas il elle ce se ne du "
    "und der die das zu den von mit auf ist nicht ein eine dem im sich als auch es er sie "
    "el y los del las por con una su para al lo como más o si no"
).split()))

# Words of the contracts: maximal runs of bytes other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back: cuts
    the lineage with files that every executor sees and that survive the loss
    of any of them."""
    path = shared_path(df.sparkSession, f"llm-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def uniform(*parts: Column) -> Column:
    """A reproducible number in (0, 1) from the hash of ``parts``."""
    bits = F.shiftrightunsigned(F.xxhash64(*parts), 11)
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))


BITMAP_BYTES = 1 << 14


def perhaps_in(keys: DataFrame, key: Column, tested: Column, most_bytes: int = BITMAP_BYTES) -> Column:
    """A condition that holds for every row whose ``tested`` hash is a ``key``
    hash of ``keys``, and for few others while the keys are few against the
    bitmap's bits: a filter ahead of a join on large rows. The bitmap has some ten
    bits a key, ``most_bytes`` (a power of two) at most."""
    size = BITMAP_BYTES
    if most_bytes > size:
        n = keys.count()
        while size < most_bytes and 8 * size < 10 * n:
            size *= 2
    bits = 8 * size
    slot = F.pmod(key, F.lit(bits))
    marked = keys.groupBy(F.floor(slot / 64).alias("at")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(slot, F.lit(64)).cast("int"))).alias("bits"))
    bitmap = bytearray(size)
    for r in marked.collect():  # size / 8 rows at most
        bitmap[8 * r["at"]:8 * r["at"] + 8] = r["bits"].to_bytes(8, "little", signed=True)
    slot = F.pmod(tested, F.lit(bits))
    byte = F.conv(F.hex(F.substring(F.lit(bytes(bitmap)), (F.floor(slot / 8) + 1).cast("int"), F.lit(1))), 16, 10)
    return F.call_function("shiftright", byte.cast("int"), F.pmod(slot, F.lit(8)).cast("int")).bitwiseAND(F.lit(1)) == 1
