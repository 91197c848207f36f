"""Registered queries: each operator, with production parameters, over its
whole table. Contract digests are derived here from the operators' outputs."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .alignment import align_documents
from .common import WORD, documents
from .importance import resample
from .line_dedup import dedup_lines
from .mixing import mix_sources
from .ngram_join import jaccard_groups
from .packing import pack_documents
from .periodic_runs import periodic_runs
from .preference import format_preferences, swapped_replies
from .quality_rules import judge_documents
from .sharding import shuffle_shards
from .spotsigs import compare_edited
from .suffix_dedup import drop_repeats
from .warc import archive_round_trip

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path() -> str:
    import public_tokenizers

    return os.environ.get("TXNRISK_TOKENIZER", public_tokenizers.path("byte_bpe_50k.json"))


def piece_model_path() -> str:
    import public_tokenizers

    return os.environ.get("TXNRISK_PIECE_MODEL", public_tokenizers.path("piece_bpe_32k.model"))


@register
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(documents(spark, sf_dir), tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


@register
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target",
                        (F.col("copies") * F.col("size")).alias("taken"))


@register
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    judged = judge_documents(documents(spark, sf_dir), labels)
    return judged.select("doc_id", *[f"s.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines",
                                                        "n_repeat_words")], "base_failed", "kept")


@register
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet"))


ORACLE["op3_warc"] = """
with p as (select page_id, coalesce(html, '') html from pages),
d as (select page_id, octet_length(encode(html)) payload_bytes, sha1(html) payload_digest from p),
m as (select payload_digest, max(page_id) top from d where payload_bytes >= 1000 group by 1)
select d.page_id, payload_bytes::bigint payload_bytes, d.payload_digest,
  case when m.top is null or m.top = d.page_id then 'response' else 'revisit' end record_type,
  case when m.top <> d.page_id then m.top end refers_to
from d left join m on m.payload_digest = d.payload_digest
"""


def _spans(mask: str):
    return F.expr(f"array_join(transform({mask}, m -> concat(m.start, '-', m.end)), ' ')").alias(mask)


@register
def op8_preference_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen, rejected = swapped_replies(spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet"))
    pairs = format_preferences(chosen, rejected)
    return pairs.select("pair_id", "n_prompt_turns", "prompt", "chosen", _spans("chosen_mask"), "rejected",
                        _spans("rejected_mask"))


ORACLE["op8_preference_formatting"] = """
with t as (select conv_id pair_id, turn, role, text from conversations where conv_id is not null),
l as (select pair_id, turn last_turn, coalesce(text, '') reply from (select *, row_number() over
        (partition by pair_id order by turn desc, coalesce(text, '') desc) k
      from t where role = 'assistant' and turn is not null) where k = 1),
s as (select a.pair_id, a.last_turn, b.reply swap from l a join l b on b.pair_id = xor(a.pair_id, 1)),
both_sides as (
  select 'c' side, t.* from t join s using (pair_id)
  union all
  select 'r', t.pair_id, turn, role, case when turn = last_turn and role = 'assistant' then swap else text end
  from t join s using (pair_id)),
o as (select *, row_number() over (partition by side, pair_id order by turn is null, turn, role, text) pos,
        '<|' || coalesce(role, 'unknown') || '|>' || chr(10) head, coalesce(text, '') body from both_sides),
e as (select coalesce(c.pair_id, r.pair_id) pair_id, coalesce(c.pos, r.pos) pos,
        c.pos is not null and r.pos is not null and c.role is not distinct from r.role
          and c.text is not distinct from r.text same
      from (from o where side = 'c') c full join (from o where side = 'r') r on c.pair_id = r.pair_id and c.pos = r.pos),
n as (select pair_id, coalesce(min(pos) filter (not same) - 1, max(pos)) n from e group by 1),
a as (select o.*, n, sum(length(head) + length(body) + 1) over (partition by side, o.pair_id, pos > n order by pos)
        - length(body) - 1 body_at from o join n on n.pair_id = o.pair_id),
g as (select pair_id, n,
  coalesce(string_agg(head || body || chr(10), '' order by pos) filter (side = 'c' and pos <= n), '') prompt,
  coalesce(string_agg(head || body || chr(10), '' order by pos) filter (side = 'c' and pos > n), '') chosen,
  coalesce(string_agg(body_at || '-' || (body_at + length(body)), ' ' order by pos)
           filter (side = 'c' and pos > n and role = 'assistant'), '') chosen_mask,
  coalesce(string_agg(head || body || chr(10), '' order by pos) filter (side = 'r' and pos > n), '') rejected,
  coalesce(string_agg(body_at || '-' || (body_at + length(body)), ' ' order by pos)
           filter (side = 'r' and pos > n and role = 'assistant'), '') rejected_mask
  from a group by 1, 2)
select pair_id, n::bigint n_prompt_turns, prompt, chosen, chosen_mask, rejected, rejected_mask from g
"""


@register
def op9_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    sample = resample(documents(spark, sf_dir), labels, target="quality = 1 and toxic = 0", wanted="quality = 1")
    return sample.withColumn("kept", F.lit(True))


@register
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = dedup_lines(documents(spark, sf_dir))
    return lines.select("doc_id", F.size(F.split("text", "\n")).cast("long").alias("n_kept"),
                        F.size("removed_line_numbers").cast("long").alias("n_removed"),
                        F.sha2("text", 256).alias("kept_sha256"))


@register
def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = jaccard_groups(documents(spark, sf_dir), n=4, percent=85)
    return groups.select("doc_id", "n_shingles", "component_id")


@register
def op7_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_edited(documents(spark, sf_dir))


@register
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_repeats(documents(spark, sf_dir))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@register
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = align_documents(documents(spark, sf_dir), tokenizer_path(), piece_model_path())
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2("groups", 256))
    return aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                          digest.alias("groups_sha256"))


SHARDS = 40


@register
def op12_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = documents(spark, sf_dir).select("doc_id", (F.octet_length(text).cast("long") + 16).alias("size"),
                                           F.crc32(text).alias("text_crc32"))
    placed = shuffle_shards(rows, SHARDS)
    # equal counts are the law; texts that repeat are dealt out like all others
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def periodic_tails(docs: DataFrame) -> DataFrame:
    """The texts of the contract: where the hash h of an id is a multiple of
    ten, the words from a = g % n on become a repetition of the p first of
    them (g = h div 10). Null ids and texts without words stay."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.call_function("div", h, F.lit(10))

    def edited(words):  # bound once: a column would be taken apart for every use
        n = F.size(words).cast("long")
        a = g % n
        p = F.call_function("div", n - a, F.lit(3) + g % 8) + 1
        times = F.call_function("div", n - a, p) + 1
        tail = F.flatten(F.array_repeat(F.slice(words, (a + 1).cast("int"), p.cast("int")), times.cast("int")))
        whole = F.slice(F.concat(F.slice(words, F.lit(1), a.cast("int")), tail), F.lit(1), F.size(words))
        return F.when(F.size(words) > 0, F.array_join(whole, " "))

    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    text = F.when(h % 10 == 0, F.transform(F.array(words), edited)[0]).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


@register
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(periodic_tails(documents(spark, sf_dir)))
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("least"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    digest = F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256)
    top = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                       digest.alias("runs_sha256"), "collapsed_sha256")
    start, length, period = -F.col("best.back"), F.col("best.length"), -F.col("best.least")
    return top.select("doc_id", "n_runs", start.alias("start"), length.alias("length"), period.alias("period"),
                      F.call_function("div", length * 1000, period).alias("exponent_milli"), "runs_sha256",
                      "collapsed_sha256")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
