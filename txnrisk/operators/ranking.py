"""Ranks and running sums without a single-task window.

``row_number().over(Window.orderBy(...))`` with no partition moves every row
to one task. Here the rows are range-partitioned on (group, order) keys, each
partition ranks its own rows, and a tiny table of per-(partition, group)
counts - at most partitions + groups rows - gives each partition its offset.
A group spread over many partitions (one cluster holding most customers) is
therefore ranked by many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import write_stage_table


def _partitions(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8")))


def running_total(df: DataFrame, order: list[Column], group: list[str] | None = None,
                  weight: Column | None = None, name: str = "running", partitions: int | None = None,
                  few_groups: bool = True, total_name: str | None = None) -> DataFrame:
    """Inclusive running sum of ``weight`` (default 1 = ordinal rank, 1-based)
    in ``order`` within ``group``. ``order`` must be a total order (end with a
    unique key) for ranks to be deterministic. ``total_name`` adds the group's
    whole sum, which the offsets table knows anyway."""
    group = group or []
    w = weight if weight is not None else F.lit(1)
    n = _partitions(df, partitions)
    p = (df.withColumn("_w", w.cast("long") if weight is None else w)
           .repartitionByRange(n, *[F.col(g) for g in group], *order)
           .withColumn("_pid", F.spark_partition_id()))
    # The range partitioner samples its bounds on every evaluation, so the two
    # branches below must read one written assignment.
    p = write_stage_table(p, "ranges")
    local_w = Window.partitionBy("_pid", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = p.withColumn("_local", F.sum("_w").over(local_w))
    counts = p.groupBy("_pid", *group).agg(F.sum("_w").alias("_part_total"))
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1) if group \
        else Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.withColumn("_off", F.coalesce(F.sum("_part_total").over(before), F.lit(0)))
    if total_name:
        offs = offs.withColumn(total_name, F.sum("_part_total").over(whole))
    offs = offs.drop("_part_total")
    # offs has at most (partitions + groups) rows; with few groups (typologies,
    # clusters) that bound is small and it is broadcast, otherwise joined.
    out = local.join(F.broadcast(offs) if few_groups else offs, ["_pid", *group])
    return out.withColumn(name, F.col("_off") + F.col("_local")).drop("_w", "_pid", "_local", "_off")


def ordinal_rank(df: DataFrame, order: list[Column], group: list[str] | None = None,
                 name: str = "rank", partitions: int | None = None) -> DataFrame:
    """1-based ordinal rank (ties must already be broken by ``order``)."""
    return running_total(df, order, group, None, name, partitions)


def group_sizes(df: DataFrame, group: list[str], name: str = "group_size") -> DataFrame:
    """Attach the group size. For few groups (clusters): one row per group is
    broadcast, so a group with most rows is not shuffled."""
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias(name))
    return df.join(F.broadcast(sizes), group)
