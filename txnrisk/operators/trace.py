"""Readable indicator trace, built with array higher-order functions inside
the JVM (no row-wise Python).

For every customer: keep indicators with points > 0 whose impact (points x
typology weight, or points x the typology's anomaly score for the dynamic
variant) is at least 0.015; severity H if points > 0.20, M if >= 0.10, else L;
keep the top 5 by impact (ties keep column order); group them by typology in
first-seen order: ``Struct: STRUCT-001(H), PROF-007(M) | Geo: GEO-002(H)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from .rules import RULES, indicator_column_name, indicator_ids


def _items(impact_weight: dict[str, Column]) -> Column:
    structs = []
    for ordinal, typ, ind in indicator_ids(RULES):
        pts = F.col(f"`{indicator_column_name(typ, ind)}`")
        structs.append(F.struct(
            F.lit(ordinal).alias("ord"),
            F.lit(K.TYPOLOGY_PREFIX[typ]).alias("typ"),
            F.lit(ind).alias("ind"),
            pts.alias("points"),
            (pts * impact_weight[typ]).alias("impact"),
        ))
    return F.array(*structs)


def trace_array(impact_weight: dict[str, Column] | None = None, top_n: int = K.TRACE_TOP_N) -> Column:
    """array<struct<typ, ind, sev, impact>> of the kept indicators, in trace
    order (typology groups in first-seen order, impact order inside)."""
    if impact_weight is None:
        impact_weight = {t: F.lit(K.TYPOLOGY_WEIGHTS[t]) for t in K.TYPOLOGIES}
    kept = F.filter(_items(impact_weight),
                    lambda x: (x["points"] > 0) & (x["impact"] >= K.TRACE_MIN_IMPACT))
    ranked = F.sort_array(F.transform(kept, lambda x: F.struct(
        (-x["impact"]).alias("k1"), x["ord"].alias("k2"), x["typ"].alias("typ"),
        x["ind"].alias("ind"), x["points"].alias("points"), x["impact"].alias("impact"))))
    top = F.slice(ranked, 1, top_n)
    typs = F.transform(top, lambda x: x["typ"])
    grouped = F.sort_array(F.transform(top, lambda x, i: F.struct(
        F.array_position(typs, x["typ"]).alias("g"), i.alias("i"), x["typ"].alias("typ"),
        x["ind"].alias("ind"), x["points"].alias("points"), x["impact"].alias("impact"))))
    return F.transform(grouped, lambda x: F.struct(
        x["typ"].alias("typ"), x["ind"].alias("ind"),
        F.when(x["points"] > K.TRACE_SEVERITY_HIGH, F.lit("H"))
         .when(x["points"] >= K.TRACE_SEVERITY_MEDIUM, F.lit("M"))
         .otherwise(F.lit("L")).alias("sev"),
        x["impact"].alias("impact")))


def trace_text(arr: Column) -> Column:
    """Render the trace array; '' when empty."""
    def part(x, i):
        item = F.concat(x["ind"], F.lit("("), x["sev"], F.lit(")"))
        prev_typ = F.element_at(arr, i)["typ"]      # 1-based: element before x
        head = F.concat(x["typ"], F.lit(": "), item)
        return (F.when(i == 0, head)
                 .when(prev_typ != x["typ"], F.concat(F.lit(" | "), head))
                 .otherwise(F.concat(F.lit(", "), item)))
    return F.array_join(F.transform(arr, part), "")


def with_indicator_trace(points: DataFrame, dynamic: bool = False,
                         name: str = "rule_indicator_trace", keep_array: bool = False) -> DataFrame:
    """Add the trace text (and optionally the array). ``dynamic`` weighs each
    indicator by the customer's anomaly score of its typology
    (``if_score_<typology>`` columns must be present)."""
    weights = None
    if dynamic:
        weights = {t: F.coalesce(F.col(f"if_score_{t}"), F.lit(0.0)) for t in K.TYPOLOGIES}
    arr = trace_array(weights)
    out = points.withColumn("_trace", arr).withColumn(name, trace_text(F.col("_trace")))
    if keep_array:
        return out.withColumnRenamed("_trace", name + "_items")
    return out.drop("_trace")


def trace_counts(trace: Column) -> dict[str, Column]:
    """Indicators per typology read back from trace text: split on '|', take
    the prefix before ':' (any of the known aliases, case-insensitive), count
    the non-blank comma items after it."""
    segs = F.split(F.coalesce(trace, F.lit("")), r"\|")
    parsed = F.transform(segs, lambda s: F.struct(
        F.lower(F.trim(F.substring_index(s, ":", 1))).alias("p"),
        F.when(F.instr(s, ":") > 0,
               F.size(F.filter(F.split(F.substr(s, F.instr(s, ":") + 1), ","),
                               lambda it: F.trim(it) != F.lit(""))))
         .otherwise(F.lit(0)).alias("n")))
    out = {}
    for typ in K.TYPOLOGIES:
        aliases = [a for a, t in K.TRACE_PREFIX_ALIASES.items() if t == typ]
        out[typ] = F.aggregate(
            parsed, F.lit(0),
            lambda acc, x: acc + F.when(x["p"].isin(aliases), x["n"]).otherwise(F.lit(0)))
    return out
