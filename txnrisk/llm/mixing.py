"""Mixing sources to target weights by pivotal dependent rounding.

Each source gets a target mass (words, by default). A document of a source
with ratio q = target / size is wanted q times: floor(q) whole copies and a
fractional copy probability. Rounding keeps the mass: two documents with open
probabilities meet, a random one of two mass-preserving transfers is made (the
odds keep every expectation), and at least one of them becomes 0 or 1; the
other goes on. A group of at most ``fan`` documents is folded this way in one
``aggregate`` call and leaves one open document, and the open ones of all
groups meet again one level up: a reduction tree of log_fan(rows) levels whose
nodes are ordinary shuffled groups. At the root one document per source is
left and goes to the nearer end (not by chance: this keeps a source's taken
mass within half a document of its target).

Groups follow a distributed rank within the source, so no group is larger than
``fan``, a source with a third of all rows is folded by many tasks, and reruns
(whatever the partitioning) agree: every random number is a hash of the
documents that meet.

Nulls: null text has size 0; a null source is a source of its own, sorted
last. Rows of size 0 are taken 0 times. Repeated rows are rounded separately.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import running_total
from .common import WORD, stage, text_or_empty

FAN = 64
SEED = 7


def word_count(col: str = "text") -> Column:
    return F.regexp_count(text_or_empty(col), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """One row per source: (source, source_size, target, source_no).

    Sources are weighted by their order (code points, null last), ``weights``
    repeating. The targets are min(cap * size, level * weight) with the level
    that makes them add up; it is the largest of the levels that each number of
    capped sources (in the order of cap / weight) would give."""
    per = stage(sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size")), "mix-sources")
    by_name = [F.col("source").cast("binary").asc_nulls_last()]
    n = len(weights)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.col("source_no") - 1) % n + 1).cast("int"))
    per = (running_total(per, by_name, name="source_no")
           .withColumn("weight", w).withColumn("most", F.col("source_size") * F.lit(float(cap))))
    total = F.lit(float(share)) * F.lit(float(per.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]))
    all_w = F.lit(float(per.agg(F.coalesce(F.sum("weight"), F.lit(0.0))).first()[0]))
    order = [(F.col("most") / F.col("weight")).asc(), F.col("source_no").asc()]
    ranked = running_total(per, order, weight=F.col("most"), name="most_to")
    ranked = running_total(ranked, order, weight=F.col("weight"), name="weight_to")
    level = ranked.agg(F.max((total - (F.col("most_to") - F.col("most")))
                             / (all_w - (F.col("weight_to") - F.col("weight")))).alias("level")).first()[0] or 0.0
    return ranked.select("source", "source_size", "source_no",
                         F.least("most", F.lit(float(level)) * F.col("weight")).alias("target"))


# One meeting of the open document (o) and the next one (x), both with mass
# and an open probability. up: mass that can go from x to o; down: from o to x.
_MEET = """
aggregate(items, cast(named_struct('open', cast(null as {item}), 'done', cast(array() as array<{item}>)) as {state}),
  (s, x) -> if(s.open is null, named_struct('open', x, 'done', s.done),
    transform(array(named_struct('o', s.open, 'x', x,
        'up', least((1 - s.open.p) * s.open.size, x.p * x.size),
        'down', least(s.open.p * s.open.size, (1 - x.p) * x.size),
        'u', (shiftrightunsigned(xxhash64({seed}, s.open.rank, x.rank, s.open.source_no), 11) + 0.5D) / 9007199254740992D)),
      m -> transform(array(named_struct('m', m,
          'go', if(m.u * (m.up + m.down) < m.down, m.up, -m.down))),
        t -> transform(array(named_struct(
            'po', {clean_o}, 'px', {clean_x})),
          n -> if(n.po in (0D, 1D),
            named_struct('open', if(n.px in (0D, 1D), cast(null as {item}), {new_x}),
                         'done', concat(s.done, array({new_o}), if(n.px in (0D, 1D), array({new_x}), cast(array() as array<{item}>)))),
            named_struct('open', {new_o}, 'done', concat(s.done, array({new_x})))))[0])[0])[0]))
"""
_ITEM = "struct<rank:bigint,doc_id:bigint,source_no:bigint,size:bigint,p:double>"


def _fold(seed: int) -> str:
    def clean(value: str) -> str:  # what rounding of doubles leaves beside 0 and 1
        return f"if({value} < 1e-12D, 0D, if({value} > 1 - 1e-12D, 1D, {value}))"

    def item(who: str, p: str) -> str:
        return (f"named_struct('rank', t.m.{who}.rank, 'doc_id', t.m.{who}.doc_id, 'source_no', t.m.{who}.source_no, "
                f"'size', t.m.{who}.size, 'p', {p})")

    return _MEET.format(item=_ITEM, state=f"struct<open:{_ITEM},done:array<{_ITEM}>>", seed=seed,
                        clean_o=clean("(t.m.o.p + t.go / t.m.o.size)"), clean_x=clean("(t.m.x.p - t.go / t.m.x.size)"),
                        new_o=item("o", "n.po"), new_x=item("x", "n.px"))


def round_copies(rows: DataFrame, seed: int = SEED, fan: int = FAN) -> DataFrame:
    """``rows`` (doc_id, source_no, size > 0, p in (0, 1)) with p rounded to 0
    or 1 so that every source keeps its sum of size * p up to one document."""
    order = [F.col("doc_id").asc_nulls_last(), F.col("size").asc()]
    open_ = running_total(rows, order, group=["source_no"], name="rank", few_groups=False)
    item = F.struct("rank", "doc_id", "source_no", "size", "p")
    done, level = None, 0
    most = open_.agg(F.max("rank")).first()[0] or 0
    while most > 1 or level == 0:
        level += 1
        width = fan ** level
        groups = (open_.select("source_no", F.floor((F.col("rank") - 1) / width).alias("node"), item.alias("item"))
                  .groupBy("source_no", "node")
                  .agg(F.array_sort(F.collect_list("item")).alias("items")))
        folded = stage(groups.select(F.expr(_fold(seed + level)).alias("s")), f"mix-level{level}")
        part = folded.select(F.explode("s.done").alias("x")).select("x.*")
        done = part if done is None else done.unionByName(part)
        open_ = folded.where("s.open is not null").select("s.open.*")
        most = -(-most // fan)
    last = open_.withColumn("p", F.when(F.col("p") >= 0.5, 1.0).otherwise(0.0))
    return done.unionByName(last)


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0,
                id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", seed: int = SEED,
                ) -> DataFrame:
    """(doc_id, size, source_size, target, copies) for every row of ``docs``:
    how often the mix takes it. ``share`` of all sizes is dealt to the sources
    by ``weights``, none above ``cap`` times its own size."""
    sizes = stage(docs.select(F.col(id_col).cast("long").alias("doc_id"),
                              F.col(source_col).cast("string").alias("source"),
                              word_count(text_col).alias("size")), "mix-sizes")
    targets = stage(source_targets(sizes, weights, share, cap), "mix-targets")
    rows = (sizes.join(targets, sizes["source"].eqNullSafe(targets["source"])).drop("source")
            .withColumn("q", F.when(F.col("size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
            .withColumn("whole", F.floor("q")).withColumn("p", F.col("q") - F.col("whole")))
    open_ = F.col("p").between(1e-12, 1 - 1e-12)
    rows = rows.withColumn("whole", F.when(F.col("p") > 1 - 1e-12, F.col("whole") + 1).otherwise(F.col("whole")))
    rounded = round_copies(rows.where(open_).select("doc_id", "source_no", "size", "p"), seed)
    per_source = targets.select("source_no", "source_size", "target",
                                F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                                .otherwise(F.lit(0)).alias("whole"))
    back = rounded.join(per_source, "source_no").select(
        "doc_id", "size", "source_size", "target", (F.col("whole") + F.col("p")).cast("long").alias("copies"))
    sure = rows.where(~open_).select("doc_id", "size", "source_size", "target",
                                     F.when(F.col("size") > 0, F.col("whole")).otherwise(0).cast("long").alias("copies"))
    return sure.unionByName(back)


def apply_mix(docs: DataFrame, copies: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every row repeated as often as ``copies`` (doc_id, size,
    copies) says. Rows with equal ids and sizes share their copies as evenly as
    can be. The texts are shuffled once: window and join have the same keys."""
    id_ = F.col(f"`{id_col}`").cast("long")
    key = ["no_id", "id", "size"]
    left = docs.select(id_.isNull().alias("no_id"), F.coalesce(id_, F.lit(0).cast("long")).alias("id"),
                       word_count(f"`{text_col}`").alias("size"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    nth = F.row_number().over(Window.partitionBy(*key).orderBy(F.xxhash64("row")))
    right = copies.groupBy(F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0).cast("long")).alias("id"),
                           "size").agg(F.sum("copies").alias("total"), F.count(F.lit(1)).alias("n")).where("total > 0")
    joined = left.join(right, key).withColumn("nth", nth)
    times = F.expr("cast(total div n + if(nth <= total % n, 1, 0) as int)")
    return (joined.withColumn("times", times).where("times > 0")
            .select("row", F.explode(F.expr("sequence(1, times)")).alias("copy"))
            .select(*[F.col("row").getField(c).alias(c) for c in docs.columns]))
