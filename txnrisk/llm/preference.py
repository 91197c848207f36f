"""Chat formatting: preference pairs.

Two conversations of a pair, chosen and rejected, are compared turn by turn;
their longest common turn prefix (equal role and text, in order) is rendered
once as the prompt, the rest of each as its completion. The mask of a
completion is the list of character spans [start, end) of its assistant turns'
texts: headers and other roles bear no loss.

One shuffle brings a pair's turns together; everything else is array
functions. Turns are ordered by turn number (nulls last), then role and text,
so ties and repeated rows have one order. A null role renders as ``unknown``,
a null text as empty; both count as equal to another null. Rows without a pair
id cannot be paired and are left out, and so are pairs with only one side.
Equal conversations give empty completions with empty masks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAD, TAIL = "<|{}|>\n", "\n"


def _turns(df: DataFrame, side: int) -> DataFrame:
    return df.select("pair_id", F.struct(
        F.lit(side).alias("side"), F.col("turn").isNull().alias("unnumbered"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")).alias("t"))


def _rendered(turns: str) -> str:
    return f"array_join(transform({turns}, t -> {_turn('t')}), '')"


def _turn(t: str) -> str:
    return f"concat('<|', coalesce({t}.role, 'unknown'), '|>\\n', coalesce({t}.text, ''), '\\n')"


def _mask(turns: str, loss_role: str) -> str:
    spans = "array<struct<start:bigint,end:bigint>>"
    state = f"struct<at:bigint,spans:{spans}>"
    head = "length(coalesce(t.role, 'unknown')) + 5"
    size = "length(coalesce(t.text, ''))"
    return (f"aggregate({turns}, cast(named_struct('at', 0L, 'spans', cast(array() as {spans})) as {state}), (s, t) -> "
            f"cast(named_struct('at', s.at + {head} + {size} + 1, 'spans', if(t.role <=> '{loss_role}', "
            f"concat(s.spans, array(named_struct('start', s.at + {head}, 'end', s.at + {head} + {size}))), s.spans)) "
            f"as {state}), s -> s.spans)")


def format_preferences(chosen: DataFrame, rejected: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """``chosen`` and ``rejected``: (pair_id, turn, role, text). Returns
    (pair_id, n_prompt_turns, prompt, chosen, chosen_mask, rejected,
    rejected_mask)."""
    both = _turns(chosen, 0).unionByName(_turns(rejected, 1)).where("pair_id is not null")
    pairs = both.groupBy("pair_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    pairs = pairs.select("pair_id", F.expr("filter(turns, t -> t.side = 0)").alias("c"),
                         F.expr("filter(turns, t -> t.side = 1)").alias("r")).where("size(c) > 0 and size(r) > 0")
    pairs = pairs.withColumn("differ", F.expr(
        "array_position(zip_with(c, r, (x, y) -> x is not null and y is not null and x.role <=> y.role "
        "and x.text <=> y.text), false)"))
    pairs = pairs.withColumn("n", F.expr("cast(if(differ = 0, least(size(c), size(r)), differ - 1) as int)"))
    rest = {side: f"slice({side}, n + 1, size({side}))" for side in "cr"}
    return pairs.select(
        "pair_id", F.col("n").cast("long").alias("n_prompt_turns"),
        F.expr(_rendered("slice(c, 1, n)")).alias("prompt"),
        F.expr(_rendered(rest["c"])).alias("chosen"), F.expr(_mask(rest["c"], loss_role)).alias("chosen_mask"),
        F.expr(_rendered(rest["r"])).alias("rejected"), F.expr(_mask(rest["r"], loss_role)).alias("rejected_mask"))


def swapped_replies(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Preference pairs from plain conversations: a conversation is chosen over
    itself with its last assistant turn's text swapped for that of its
    neighbour (conv_id 2k and 2k + 1 are neighbours). Conversations without an
    assistant turn, or without a neighbour that has one, give no pair."""
    turns = conversations.select(F.col("conv_id").cast("long").alias("pair_id"), F.col("turn").cast("long").alias("turn"),
                                 F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    turns = turns.where("pair_id is not null")
    last = (turns.where("role = 'assistant' and turn is not null").groupBy("pair_id")
            .agg(F.max(F.struct("turn", F.coalesce("text", F.lit("")).alias("text"))).alias("last"))
            .select("pair_id", F.col("last.turn").alias("at"), F.col("last.text").alias("reply")))
    other = last.select(F.col("pair_id").bitwiseXOR(F.lit(1)).alias("pair_id"), F.col("reply").alias("swap"))
    swap = last.join(other, "pair_id").select("pair_id", "at", "swap")
    joined = turns.join(swap, "pair_id")
    rejected = joined.withColumn("text", F.when((F.col("turn") == F.col("at")) & (F.col("role") == "assistant"),
                                                F.col("swap")).otherwise(F.col("text")))
    names = ["pair_id", "turn", "role", "text"]
    return joined.select(names), rejected.select(names)
