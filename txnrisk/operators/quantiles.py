"""Exact population quantiles without pulling a column into one task.

``percentile`` (exact) keeps a value->count map of the whole column in the
final task; at billions of rows that is unbounded. Here every double becomes a
64-bit integer of the same order (``sort_key``), and the wanted ranks are found
digit by digit, 16 bits at a time: one aggregate counts the buckets of the next
digit, a running sum over them finds the bucket of each rank, and the next
aggregate reads only values under the prefixes found. All columns and ranks
share the aggregates, ranks of a column share its buckets, the keys are written
once and four jobs over them do for any number of rows; a rank whose bucket
holds one value is done earlier. The driver sees a row per rank and job.

Quantiles interpolate linearly around rank p * (n - 1) (the definition of
``percentile`` and of DuckDB's ``quantile_cont``).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import from_sort_key, sort_key
from ..session import write_stage_table


@dataclass(frozen=True)
class QSpec:
    name: str               # result key
    expr: Column | str      # value: a Column or SQL text (nulls and NaN ignored)
    p: float                # probability in [0, 1]


def _long_values(df: DataFrame, exprs: list[Column | str]) -> DataFrame:
    """(c, v) rows: one per input row and value expression, NULL / NaN dropped."""
    if all(isinstance(e, str) for e in exprs):
        items = ", ".join(f"named_struct('c', {i}, 'v', CAST(({e}) AS DOUBLE))" for i, e in enumerate(exprs))
        long = df.select(F.expr(f"inline(array({items}))"))
    else:
        cols = [F.expr(e) if isinstance(e, str) else e for e in exprs]
        long = (df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("c"), c.cast("double").alias("v"))
                                              for i, c in enumerate(cols)])).alias("x"))
                  .select("x.c", "x.v"))
    return long.where(F.col("v").isNotNull() & ~F.isnan("v"))


# Digits of the sort key, from the top: after the last a prefix is the key.
SHIFTS = (48, 32, 16, 0)


@dataclass
class _Rank:
    """The value of ``rank`` among those of ``column``: among the values whose
    key has the ``prefix``, the one after ``before`` smaller ones."""

    column: int
    rank: int
    prefix: int
    before: int
    value: float | None = None


def _histogram(long: DataFrame, shift: int, wanted: DataFrame, live: DataFrame | None) -> DataFrame:
    """The buckets that hold the wanted ranks, with the values in smaller
    buckets (``before``) and the smallest and largest key in them."""
    group = ["c"]
    if live is not None:
        parent = F.shiftright("k", shift + 16)
        long = long.withColumn("parent", parent).join(F.broadcast(live), ["c", "parent"])
        group = ["c", "parent"]
    buckets = long.groupBy(*group, F.shiftright("k", shift).alias("prefix")).agg(
        F.count(F.lit(1)).alias("n"), F.min("k").alias("low"), F.max("k").alias("high"))
    # at most 65,536 buckets of one digit
    order = Window.partitionBy(*group).orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0)
    counted = (buckets.withColumn("upto", F.sum("n").over(order))
                      .withColumn("total", F.sum("n").over(Window.partitionBy(*group))))
    asked = counted.join(F.broadcast(wanted), group)
    if live is None:
        at = F.col("p") * (F.col("total") - 1)
        asked = asked.withColumn("rank", F.explode(F.array(F.floor(at), F.ceil(at)).cast("array<long>")))
    return (asked.where((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n")))
                 .withColumn("before", F.col("upto") - F.col("n")))


def exact_quantiles(df: DataFrame, specs: list[QSpec]) -> dict[str, float | None]:
    """Exact quantiles for many (value, p) specs, all of them in the same jobs:
    one per digit at most."""
    exprs: list[Column | str] = []
    key_of: dict[str, int] = {}
    for s in specs:
        k = s.expr if isinstance(s.expr, str) else str(s.expr)
        if k not in key_of:
            key_of[k] = len(exprs)
            exprs.append(s.expr)
    if not specs:
        return {}
    spark = df.sparkSession
    column = {s.name: key_of[s.expr if isinstance(s.expr, str) else str(s.expr)] for s in specs}
    # every digit reads the keys: they are computed once, not in each job
    long = write_stage_table(_long_values(df, exprs).select("c", sort_key(F.col("v")).alias("k")), "quantile-keys")
    wanted = spark.createDataFrame(sorted({(column[s.name], float(s.p)) for s in specs}), "c int, p double")
    totals: dict[int, int] = {}
    ranks: dict[tuple[int, int], _Rank] = {}
    for r in _histogram(long, SHIFTS[0], wanted, None).collect():
        totals[r["c"]] = r["total"]
        ranks[r["c"], r["rank"]] = _Rank(r["c"], r["rank"], r["prefix"], r["before"],
                                         from_sort_key(r["low"]) if r["low"] == r["high"] else None)
    for shift in SHIFTS[1:]:
        open_ = [r for r in ranks.values() if r.value is None]
        if not open_:
            break
        live = spark.createDataFrame(sorted({(r.column, r.prefix) for r in open_}), "c int, parent long")
        wanted = spark.createDataFrame([(r.column, r.prefix, r.rank - r.before, r.rank) for r in open_],
                                       "c int, parent long, rank long, overall long")
        for found in _histogram(long, shift, wanted, live).collect():
            r = ranks[found["c"], found["overall"]]
            r.prefix, r.before = found["prefix"], r.before + found["before"]
            r.value = from_sort_key(found["low"]) if found["low"] == found["high"] else None
    result: dict[str, float | None] = {}
    for s in specs:
        c = column[s.name]
        if c not in totals:
            result[s.name] = None
            continue
        at = s.p * (totals[c] - 1)
        low, high = ranks[c, math.floor(at)].value, ranks[c, math.ceil(at)].value
        result[s.name] = low + (high - low) * (at - math.floor(at)) if high != low else low
    return result


# Values of a key that may form one array; a task holds the arrays of 128 keys
# at most before it goes on sorted by key, with one at a time.
HOT_ROWS = 50_000


def grouped_median(df: DataFrame, key: str, value: str, name: str = "median") -> DataFrame:
    """Exact per-key median (linear interpolation, as ``percentile(v, 0.5)``)
    that stays distributed when one key holds a large share of the rows.

    The values of a key with at most ``HOT_ROWS`` rows become one sorted array;
    those of the others (at most rows / ``HOT_ROWS`` keys, so their list is
    broadcast) go through ``_spread_median``."""
    v = F.col(value).cast("double")
    values = df.where(v.isNotNull() & ~F.isnan(v)).select(key, v.alias("_v"))
    hot = values.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > HOT_ROWS).select(F.col(key).alias("_hot"))
    hot = write_stage_table(hot, "hot-keys")
    if hot.isEmpty():
        return _array_median(values, key, name)
    is_hot = F.col(key).eqNullSafe(F.col("_hot"))
    few = values.join(F.broadcast(hot), is_hot, "left_anti")
    many = values.join(F.broadcast(hot), is_hot, "left_semi")
    return _array_median(few, key, name).unionByName(_spread_median(many, key, name))


def _array_median(values: DataFrame, key: str, name: str) -> DataFrame:
    """The mean of the one or two values at ranks floor((n-1)/2) and
    ceil((n-1)/2) of each key. Only doubles are sorted, not rows, and what is
    shuffled is arrays, as far as rows of a key meet before."""
    arrays = values.groupBy(key).agg(F.sort_array(F.collect_list("_v")).alias("_a"))
    return arrays.select(key, F.expr("_a[(size(_a) - 1) div 2] * 0.5D + _a[size(_a) div 2] * 0.5D").alias(name))


def _spread_median(values: DataFrame, key: str, name: str) -> DataFrame:
    """(key, value) pairs are pre-aggregated to multiplicities (map-side), then
    a range-partitioned running total over (key, value) - a hot key spans many
    tasks - gives each distinct value its rank interval; the one or two
    values covering ranks floor((n-1)/2) and ceil((n-1)/2) are averaged."""
    from .ranking import running_total

    vc = values.groupBy(key, "_v").agg(F.count(F.lit(1)).alias("_c"))
    # the group's total comes with the offsets: no join on the bare key, which
    # would bring all values of a hot key into one task
    j = running_total(vc, [F.col("_v").asc()], [key], F.col("_c"), "_cum", few_groups=False, total_name="_n")
    lo = F.floor((F.col("_n") - 1) / 2)
    hi = F.ceil((F.col("_n") - 1) / 2)
    start = F.col("_cum") - F.col("_c")
    hit_lo = (start <= lo) & (lo < F.col("_cum"))
    hit_hi = (start <= hi) & (hi < F.col("_cum"))
    picked = j.where(hit_lo | hit_hi).select(
        key, F.when(hit_lo, F.col("_v")).alias("_lo"), F.when(hit_hi, F.col("_v")).alias("_hi"))
    return picked.groupBy(key).agg(
        (F.max("_lo") * 0.5 + F.max("_hi") * 0.5).alias(name))
