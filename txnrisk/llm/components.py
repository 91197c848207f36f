"""Connected groups of linked items, without all pairs of a bucket.

``linked_groups`` takes postings: which items fall into which bucket. Two items
are linked if they share a bucket and pass a check; wanted are only the
connected groups. In a round every item meets the pivot of each of its buckets,
checks the first one of another group that it can be near to, and the links
found join groups: one check per item and round. The first round takes the
pivots that most items should be linked to, the others random ones. Only pairs
from different groups can still change anything, so the exact rest is a join of
the buckets that hold several groups, on items of different groups; within a
large group of near copies nothing is left to compare."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

# items of a bucket that meet in one task at once
CHUNK = 512


@dataclass
class PairsInBuckets:
    """How the exact rest is compared where its pairs meet, so that few pairs are
    shuffled. ``texts``: (id, and what ``linked`` needs of an item). ``linked``:
    holds for all links and few others, which ``verify`` then sees. ``band``: a whole
    number, which differs by one at most between items that are near."""

    texts: DataFrame
    linked: Callable[[Column, Column], Column]
    band: Callable[[Column], Column]


def _are_stars(edges: DataFrame) -> bool:
    """Whether every u has one v, and no v is a u."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("from"), F.lit(0).alias("to")).unionByName(
        edges.select(F.col("v").alias("id"), F.lit(0).alias("from"), F.lit(1).alias("to")))
    ends = ends.groupBy("id").agg(F.sum("from").alias("from"), F.max("to").alias("to"))
    return ends.where("from > 1 or from > 0 and to > 0").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) -> (id, component): the smallest id that each item of an
    edge reaches. Alternates large-star and small-star steps, whose number
    grows with the logarithm of the longest path, until all edges lead from an
    item to its component; each step's edges go to the shared folder."""
    e = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(),
              "edges")
    while not _are_stars(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.withColumnRenamed("m", "v")).where("u <> v").distinct())
        e = stage(small, "edges")
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def _with_group(members: DataFrame, group: DataFrame) -> DataFrame:
    """``members`` (key, item) with ``own``, the item's group, in the buckets
    that hold several groups."""
    own = members.join(group, members["item.id"] == group["id"], "left").select(
        "key", "item", F.coalesce("component", "item.id").alias("own"))
    own = stage(own, "members")
    several = own.groupBy("key").agg(F.min("own").alias("lo"), F.max("own").alias("hi")).where("lo <> hi").select("key")
    return own.join(several, "key")


def _pair(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _with_texts(rest: DataFrame, texts: DataFrame) -> DataFrame:
    """``rest`` with the texts among the items' fields, and the number of ``parts``
    that a bucket is dealt in."""
    fields = [c for c in texts.columns if c != "id"]
    size = F.count(F.lit(1)).over(Window.partitionBy("key"))
    rest = rest.withColumn("parts", F.ceil(size / CHUNK).cast("int"))
    return rest.join(texts, rest["item.id"] == texts["id"]).select(
        "key", F.struct("item.*", *fields).alias("item"), "own", "keys", "parts")


def pairs_between_groups(rest: DataFrame, near: Callable[[Column, Column], Column], once: bool,
                         within: PairsInBuckets | None = None) -> DataFrame:
    """``rest`` (key, item, own) -> (a, b): items of different groups that share a
    bucket and are near. ``once``: ``rest`` has the ``keys`` of each item too, and a
    pair comes out of the smallest common one only. ``within``: only pairs that are
    linked; ``rest`` has texts and parts. Only neighbouring bands of a bucket meet,
    and each part of a bucket meets the whole of it by itself."""
    key, own = F.col("x.key") == F.col("y.key"), F.col("x.own") < F.col("y.own")
    if within:
        tasks = int(rest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        rest = rest.withColumn("band", within.band(F.col("item")))
        x = rest.withColumn("part", F.pmod(F.xxhash64("item.id"), "parts").cast("int"))
        y = rest.withColumn("own_band", F.col("band")).withColumn("band", F.explode(F.array(F.col("band"), F.col("band") + 1)))
        y = y.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        x, y = (side.repartition(tasks, "key", "band", "part").alias(name) for side, name in ((x, "x"), (y, "y")))
        key = key & (F.col("x.band") == F.col("y.band")) & (F.col("x.part") == F.col("y.part"))
        # of two bands the item of the higher one is x, whatever the groups' order
        own = own | ((F.col("x.own") > F.col("y.own")) & (F.col("y.own_band") < F.col("x.band")))
    else:
        x, y = rest.alias("x"), rest.alias("y")
    on = key & own & near(F.col("x.item"), F.col("y.item"))
    if once:
        on = on & (F.array_min(F.array_intersect("x.keys", "y.keys")) == F.col("x.key"))
    if within:
        on = on & within.linked(F.col("x.item"), F.col("y.item"))
    return x.join(y, on).select(*_pair(F.col("x.item.id"), F.col("y.item.id")))


def linked_groups(postings: DataFrame, near: Callable[[Column, Column], Column],
                  verify: Callable[[DataFrame], DataFrame], order: str, rounds: int = 2, few_keys: bool = False,
                  rest_of: PairsInBuckets | None = None) -> DataFrame:
    """``postings``: (key, item), item a struct with ``id`` and ``order`` (the
    pivots of the first round come first). ``near``: a cheap necessary condition
    on two items. ``verify``: (a, b) -> those rows that are links. ``few_keys``:
    an item has few keys, so the exact rest takes them along and makes a pair once,
    in its first common bucket (where ``near`` is not to be stricter than in a later
    one); with ``rest_of`` it is compared there. Returns (id, component) for the items
    that have links."""
    links = group = members = None

    for k in range(rounds):
        rank = F.col(f"item.{order}") if k == 0 else F.xxhash64(F.lit(k), "item.id")
        first = F.first("item").over(Window.partitionBy("key").orderBy(rank.asc(), F.col("item.id").asc()))
        if members is None:
            # two items that cannot be near have nothing more to say
            met = postings.withColumn("pivot", first).withColumn("size", F.count(F.lit(1)).over(Window.partitionBy("key")))
            met = met.where("item.id <> pivot.id").where((F.col("size") > 2) | near(F.col("item"), F.col("pivot")))
            met = stage(met.drop("size"), "met")
            members = met.select("key", "item").unionByName(met.select("key", F.col("pivot").alias("item")).distinct())
        else:
            first_own = F.first("own").over(Window.partitionBy("key").orderBy(rank.asc(), F.col("item.id").asc()))
            met = _with_group(members, group).withColumn("pivot", first).withColumn("pivot_own", first_own)
            met = met.where("own <> pivot_own")
        by = F.col(f"pivot.{order}") if k == 0 else F.xxhash64(F.lit(k), "pivot.id")
        best = met.where(near(F.col("item"), F.col("pivot"))).groupBy("item.id").agg(
            F.min(F.struct(by.alias("by"), F.col("pivot.id").alias("id"))).alias("pivot"))
        new = stage(verify(best.select(*_pair(F.col("id"), F.col("pivot.id"))).distinct()), "links")
        if k and new.isEmpty():
            break
        links = new if links is None else links.unionByName(new)
        group = stage(connected_components(links), "groups")
    rest = _with_group(members, group)
    if few_keys:
        rest = rest.withColumn("keys", F.collect_list("key").over(Window.partitionBy("item.id")))
    if rest_of:
        rest = stage(_with_texts(rest, rest_of.texts), "rest")
        new = stage(verify(stage(pairs_between_groups(rest, near, few_keys, rest_of), "linked")), "links")
    else:
        rest = stage(rest, "rest")
        found = pairs_between_groups(rest, near, few_keys)
        # a hot bucket's pairs leave one task: they are dealt out before the costly check
        tasks = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        found = found.repartition(tasks, "a", "b") if few_keys else found.distinct()
        new = stage(verify(found), "links")
    return group if new.isEmpty() else connected_components(links.unionByName(new))
