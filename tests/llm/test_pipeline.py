"""The pipeline's stages, one after the other, on the smallest tables."""

from collections import Counter, defaultdict

import corpus_pipeline as C
from txnrisk.llm.common import stage
from txnrisk.llm.line_dedup import dedup_lines
from txnrisk.llm.mixing import mix_sources
from txnrisk.llm.ngram_join import jaccard_groups
from txnrisk.llm.quality_rules import judge_documents

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    names = docs.columns
    held = []
    for name, function in C.STAGES:
        out = stage(function(spark, docs, SF), f"test-{name}")
        held.append((docs, out))
        docs = out
    for _, out in held[:-1]:
        assert out.columns == names
    (d, out) = held[0]
    assert {r.doc_id for r in out.collect()} == {r.doc_id for r in judge_documents(d, labels).where("kept").collect()}
    (d, out) = held[1]
    assert sorted((r.doc_id, r.text, r.n_chars) for r in out.collect()) == sorted(
        (r.doc_id, r.text, len(r.text)) for r in dedup_lines(d).collect())
    (d, out) = held[2]
    groups = defaultdict(list)
    for r in jaccard_groups(d, 5, 80).collect():
        groups[r.component_id if r.links else ("alone", r.doc_id)].append(r.doc_id)
    assert {r.doc_id for r in out.collect()} == {min(g) for g in groups.values()}
    (d, out) = held[3]
    copies = {r.doc_id: r.copies for r in mix_sources(d).collect() if r.copies}
    assert Counter(r.doc_id for r in out.collect()) == Counter(copies)
    (d, out) = held[4]
    pieces = out.collect()
    starts = Counter(r.doc_id for r in pieces if r.start == 0)
    assert starts == Counter(r.doc_id for r in d.collect())
    assert Counter({r.doc_id: 0 for r in pieces}).keys() == starts.keys()


def test_run_registers_all(spark):
    import __spark_entry__ as e
    known = e.queries()
    assert "pipeline" in known and [k for k in range(1, 11) if not any(n.startswith(f"op{k}_") for n in known)] == []
    assert 4 <= len(C.STAGES) <= 5
