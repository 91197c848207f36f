"""Sharding by a Feistel permutation of global row numbers.

Rows are numbered 0 to n - 1 in the order of their ids. A Feistel network over
pairs (x div b, x mod b) permutes the numbers below ``a * b``, the least such
rectangle with ``a = ceil(sqrt(n))`` and ``b = ceil(n / a)``; cycle walking -
applying it again to results of n and more - makes that a permutation of 0 to
n - 1. The permuted place p goes to shard ``p mod shards`` and there to slot
``p div shards``: counts differ by at most one, slots have no gaps, and shard
and slot follow from (row number, n, shards, seed) alone, as does the row
number from shard and slot (``row_at``). The seed gives the shuffle again.

The rectangle has less than ``a`` numbers too many, so few rows walk at all:
what each of those numbers ends at is walked once, in a table of at most
sqrt(n) rows, and joined.

Only ids, not texts, need to pass here: one shuffle, which deals rows out by
(id, hash of the row), so an id that many rows share is spread. Rows equal in
all columns are interchangeable; any other tie follows the hash. Null ids come
first. An empty table gives an empty result. The input may have columns of any
name: ``row_number``, ``shard`` and ``slot`` of the input give way to the new
ones, all others stay.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stage

PRIME = (1 << 31) - 1  # squares of residues stay below 2^62
ROUNDS = 6
PLACES = ("row_number", "shard", "slot")


def sides(n: int) -> tuple[int, int]:
    """The rectangle of the network for n numbers."""
    a = math.isqrt(n - 1) + 1 if n > 0 else 1
    b = max(1, -(-n // a))
    if a >= PRIME:
        raise ValueError("too many rows")
    return a, b


def round_keys(seed: int) -> list[tuple[int, int, int]]:
    """Three residues for each round."""
    return [tuple(1 + int.from_bytes(hashlib.sha256(f"{seed}/{r}/{i}".encode()).digest()[:8], "big") % (PRIME - 1)
                  for i in range(3)) for r in range(ROUNDS)]


def quotient(x: Column, by: Column) -> Column:
    """Whole-number division; doubles would round numbers beyond 2^53."""
    return F.call_function("div", x, by)


def network(x: Column, n: int, seed: int, back: bool = False) -> Column:
    """One pass of the network, a bijection of the numbers below a * b, or of
    its inverse. The rounds fold over an array: nested into one another they
    would be written out again and again."""
    a, b = (F.lit(s).cast("long") for s in sides(n))
    prime, keys = F.lit(PRIME).cast("long"), list(enumerate(round_keys(seed)))
    rounds = F.array(*[F.struct(F.lit(r % 2 == 0).alias("first"), *[F.lit(v).cast("long").alias(c) for c, v in zip("kmq", key)])
                       for r, key in (reversed(keys) if back else keys)])

    def step(at: Column, r: Column) -> Column:
        mix = (F.when(r["first"], at["right"]).otherwise(at["left"]) * r["k"] + r["m"]) % prime
        mix = (mix * mix % prime * r["q"] + mix) % prime

        def moved(side: Column, size: Column) -> Column:
            return F.pmod(side - mix if back else side + mix, size)
        return F.struct(F.when(r["first"], moved(at["left"], a)).otherwise(at["left"]).alias("left"),
                        F.when(r["first"], at["right"]).otherwise(moved(at["right"], b)).alias("right"))

    start = F.struct(quotient(x, b).alias("left"), (x % b).alias("right"))
    return F.aggregate(rounds, start, step, lambda at: at["left"] * b + at["right"])


def permuted(rows: DataFrame, x: str, n: int, seed: int, name: str, back: bool = False) -> DataFrame:
    """``rows`` with the permuted place of the number in column ``x``."""
    a, b = sides(n)
    # spare numbers that a row comes to: a cycle of spare numbers alone has no end
    spare = rows.sparkSession.range(n, a * b).where(network(F.col("id"), n, seed, not back) < n)
    spare = stage(spare.select(F.col("id").alias("_at"), network(F.col("id"), n, seed, back).alias("_to")), "walk")
    while not spare.where(F.col("_to") >= n).isEmpty():
        spare = stage(spare.withColumn("_to", F.when(F.col("_to") >= n, network(F.col("_to"), n, seed, back))
                                       .otherwise(F.col("_to"))), "walk")
    once = rows.withColumn("_at", network(F.col(x), n, seed, back))
    # fewer than a = ceil(sqrt(n)) rows of 16 bytes
    return once.join(F.broadcast(spare), "_at", "left").withColumn(name, F.coalesce("_to", "_at")).drop("_at", "_to")


def number_rows(rows: DataFrame, id_col: str) -> tuple[DataFrame, int]:
    """(``row`` struct, ``row_number``) in the order of the ids, and the number
    of rows. The written table fixes the numbers for all that follows."""
    hashed = [F.col(f"`{f.name}`") for f in rows.schema.fields if not _has_map(f.dataType)]
    order = [F.col("_id").asc_nulls_first(), F.col("_hash"), F.col("_tie")]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "8"))
    dealt = (rows.select(F.struct("*").alias("row"), F.col(f"`{id_col}`").alias("_id"), F.xxhash64(*hashed).alias("_hash"),
                         F.monotonically_increasing_id().alias("_tie"))
                 .repartitionByRange(parts, *order).sortWithinPartitions(*order)
                 .select("row", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_local")))
    dealt = stage(dealt, "numbered")
    counts = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # a row per partition
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    local = F.col("_local") - F.shiftleft(F.col("_part").cast("long"), 33)
    numbered = dealt.join(F.broadcast(before), "_part").select("row", (F.col("_before") + local).alias("row_number"))
    return numbered, counts.agg(F.sum("_n")).first()[0] or 0


def _has_map(kind: T.DataType) -> bool:
    return "map<" in kind.simpleString()


def shuffle_shards(rows: DataFrame, shards: int, seed: int = 0, id_col: str = "doc_id") -> DataFrame:
    """``rows`` with their ``row_number``, ``shard`` and ``slot``."""
    numbered, n = number_rows(rows, id_col)
    placed = permuted(numbered, "row_number", n, seed, "_place")
    kept = [F.col(f"row.`{c}`") for c in rows.columns if c.lower() not in PLACES]
    return placed.select(*kept, "row_number", (F.col("_place") % shards).cast("int").alias("shard"),
                         quotient(F.col("_place"), F.lit(shards)).alias("slot"))


def row_at(places: DataFrame, n: int, shards: int, seed: int = 0) -> DataFrame:
    """(``shard``, ``slot``) rows with the ``row_number`` that lies there in a
    shuffle of n rows."""
    at = places.withColumn("_place", F.col("slot") * F.lit(shards).cast("long") + F.col("shard"))
    return permuted(at, "_place", n, seed, "row_number", back=True).drop("_place")
