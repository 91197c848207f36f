"""Document fingerprints: SpotSigs.

A signature starts at an anchor (a very common word) and takes the next two
content words (words that are no anchors) after it. A document's fingerprint is
the set of its signatures, 32 bits each; it follows the running text, so lists,
menus and other text without anchors add nothing. A text without anchors has
its whole word sequence as its only signature. Two fingerprints' likeness is
the Jaccard similarity of the sets, found only between sets whose lengths allow
it. Only SQL functions are used.

Null text counts as empty; equal texts have equal fingerprints. Repeated rows
are documents of their own.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import running_total
from .common import COMMON_WORDS, stage, text_or_empty
from .components import linked_groups

ANCHORS = COMMON_WORDS


def with_signatures(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """``df`` with column ``out``: the sorted distinct signatures of a text."""
    w, c, a = f"{out}_words", f"{out}_content", f"{out}_anchors"
    df = df.withColumn(w, F.filter(F.split(F.lower(text_col), r"[\s\p{Punct}]+"), lambda x: x != ""))
    df = df.withColumn(c, F.filter(w, lambda x: ~x.isin(ANCHORS)))
    df = df.withColumn(a, F.filter(F.transform(w, lambda x, i: F.when(x.isin(ANCHORS), i)), lambda i: i.isNotNull()))
    low = F.lit(0xFFFFFFFF).cast("long")
    # before the j-th anchor, word i, there are i - j content words
    spots = F.transform(a, lambda i, j: F.xxhash64(F.get(w, i), F.get(c, i - j), F.get(c, i - j + 1)).bitwiseAND(low))
    whole = F.array(F.xxhash64(w).bitwiseAND(low))
    return df.withColumn(out, F.array_sort(F.array_distinct(F.when(F.size(a) > 0, spots).otherwise(whole)))).drop(w, c, a)


def fingerprint(signatures: str) -> Column:
    """The set as text: 8 hex digits for each signature, ascending."""
    return F.array_join(F.transform(signatures, lambda s: F.lpad(F.hex(s), 8, "0")), "")


def likeness(a: str, b: str) -> Column:
    both = F.size(F.array_intersect(a, b)).cast("double")
    return F.when(F.col(a) == F.col(b), 1.0).otherwise(both / (F.size(a) + F.size(b) - both))


def similar_groups(docs: DataFrame, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, group_id) for every row: documents connected by a likeness of
    at least ``similarity``, named by their smallest id.

    Sets are partitioned by length, partition k holding the lengths from
    similarity^-k on; linked sets are in the same or in neighbouring
    partitions. In a partition, sets meet under the signatures of their prefix
    (by hash order), and lengths that rule a link out are pruned before the
    sets are compared."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(f"`{text_col}`").alias("text"))
    rows = stage(with_signatures(rows, "text", "s").select("doc_id", "s"), "spot-sets")
    sets = rows.groupBy("s").agg(F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("copies"))
    sets = stage(sets.select("*", F.size("s").alias("n"), F.monotonically_increasing_id().alias("id")), "spot-classes")
    part = F.floor(F.log("n") / F.lit(math.log(1 / similarity)) + 1e-9)
    prefix = F.expr(f"slice(array_sort(transform(s, x -> xxhash64(x))), 1, n - cast(ceil({similarity}D * n - 1e-9) as int) + 1)")
    item = F.struct("id", "n", (-F.col("copies")).alias("order"))
    postings = (sets.select(item.alias("item"), F.explode(F.array(part, part + 1)).alias("part"), prefix.alias("p"))
                .select("item", "part", F.explode("p").alias("p")).select(F.xxhash64("part", "p").alias("key"), "item"))

    def near(x: Column, y: Column) -> Column:
        return F.least(x["n"], y["n"]) >= F.lit(similarity) * F.greatest(x["n"], y["n"]) - 1e-9

    def verify(pairs: DataFrame) -> DataFrame:
        a = sets.select(F.col("id").alias("a"), F.col("s").alias("x"))
        b = sets.select(F.col("id").alias("b"), F.col("s").alias("y"))
        return (pairs.join(a, "a").join(b, "b").where(likeness("x", "y") >= F.lit(similarity) - 1e-9)).select("a", "b")

    groups = linked_groups(postings, near, verify, "order")
    named = sets.join(groups, "id", "left").withColumn("component", F.coalesce("component", "id"))
    least = named.groupBy("component").agg(F.min("least_id").alias("group_id"))
    return rows.join(named.join(least, "component").select("s", "group_id"), "s").select("doc_id", "group_id")


def with_next(rows: DataFrame, block: int = 1000) -> DataFrame:
    """``rows`` (doc_id, text, n_chars) with ``block`` and ``place``: their
    places in descending order of ids (nulls last, equal ids by a hash of the
    text), cut into blocks of ``block`` rows. A block also holds the row that
    follows its last one, marked ``extra``; the first follows the last. So a
    window over a block finds every row's next one.

    Only keys are ranked; rows get their place by a join on (id, hash)."""
    # null ids as a key of their own, so that the join and the window below
    # share one shuffle of the texts
    key = ["no_id", "id", "hash"]
    rows = rows.select("doc_id", "text", "n_chars", F.col("doc_id").isNull().alias("no_id"),
                       F.coalesce("doc_id", F.lit(0).cast("long")).alias("id"), F.xxhash64("text").alias("hash"))
    keys = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("copies"))
    order = [F.col("no_id").asc(), F.col("id").desc(), F.col("hash").asc()]
    ranked = running_total(keys, order, weight=F.col("copies"), name="last_place")
    ranked = stage(ranked.withColumn("first_place", F.col("last_place") - F.col("copies")), "next-places")
    n = ranked.agg(F.max("last_place")).first()[0] or 0
    nth = F.row_number().over(Window.partitionBy(*key).orderBy("n_chars"))
    placed = rows.join(ranked, key).select("doc_id", "text", "n_chars", (F.col("first_place") + nth - 1).alias("place"))
    own = F.struct(F.expr(f"place div {block}").alias("block"), F.col("place"), F.lit(False).alias("extra"))
    before = F.when(F.col("place") == 0, F.lit(n)).otherwise(F.col("place"))
    extra = F.struct(((before - 1) / block).cast("long").alias("block"), before.alias("place"), F.lit(True).alias("extra"))
    at = F.when(F.col("place") % block == 0, F.array(own, extra)).otherwise(F.array(own))
    return placed.select("doc_id", "text", "n_chars", F.explode(at).alias("at")).select("doc_id", "text", "n_chars", "at.*")


def compare_edited(docs: DataFrame, part: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every text against an edited one (its last floor(n_chars / part)
    characters replaced by the first as many of the next document, or all of
    it) and against the next document."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(f"`{text_col}`").alias("text"))
    rows = with_next(rows.withColumn("n_chars", F.length("text").cast("long")))
    order = Window.partitionBy("block").orderBy("place", "extra")
    # signatures are taken above the shuffle that the first window needs
    rows = with_signatures(rows.withColumn("after", F.lead("text").over(order)), "text", "own")
    rows = rows.withColumn("next", F.lead("own").over(order)).where("not extra")
    rows = rows.select("doc_id", "n_chars", "own", "next", F.expr(
        f"concat(substring(text, 1, cast(n_chars - n_chars div {part} as int)), "
        f"substring(after, 1, cast(n_chars div {part} as int)))").alias("edited"))
    rows = with_signatures(rows, "edited", "changed")
    return rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                       fingerprint("own").alias("fingerprint"), fingerprint("changed").alias("edited_fingerprint"),
                       likeness("own", "changed").alias("near_edited"), likeness("own", "next").alias("near_next"))
