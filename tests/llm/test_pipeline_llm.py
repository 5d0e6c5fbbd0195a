from __future__ import annotations

import os

import pytest

import corpus_pipeline
import __spark_entry__ as spark_entry
from casebook.llm import common, decontaminate, ngram_join, packing
from tests.llm.frames import edge_documents
from tests.llm.test_ngram_join import expected as near_groups

SF = "/root/testdata/sf0.001"


def test_stages_agree_with_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = corpus_pipeline.language_stage(spark, docs, SF)
    assert first.columns == docs.columns
    texts = {r.doc_id: r.text for r in first.collect()}
    assert len(texts) == docs.count()  # all have letters and a clear language

    groups = {}
    for key, text in texts.items():
        groups.setdefault("".join(c.lower() if "A" <= c <= "Z" else c for c in text), []).append(key)
    second = corpus_pipeline.exact_stage(spark, first, SF)
    assert second.columns == docs.columns
    kept = {r.doc_id for r in second.collect()}
    assert kept == {max(keys) for keys in groups.values()}

    rows = [(k, texts[k]) for k in sorted(kept)]
    third = corpus_pipeline.near_stage(spark, second, SF)
    assert third.columns == docs.columns
    left = {r.doc_id for r in third.collect()}
    assert left == {c for _, c in near_groups(rows, corpus_pipeline.SHINGLE_WORDS, *corpus_pipeline.SIMILARITY).values()}

    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    fourth = corpus_pipeline.decontamination_stage(spark, third, SF)
    assert fourth.columns == docs.columns
    clean = {r.doc_id for r in fourth.collect()}
    marked = decontaminate.with_hits(decontaminate.find(third, bench))
    assert clean == left - {r.doc_id for r in marked.where("contaminated").collect()}

    assert {r.doc_id for r in corpus_pipeline.packing_stage(spark, fourth, SF).collect()} == clean


def test_scratch_tables_go(spark, run_dir, monkeypatch):
    made = []
    monkeypatch.setattr(common, "shared_dir", lambda spark, label: made.append(f"{run_dir}/{len(made)}/{label}") or made[-1])
    packed = corpus_pipeline.run(spark, SF)
    assert len(made) == 3  # its own, and those of two stages
    assert os.listdir(run_dir) == ["0"] and os.listdir(made[0]) == ["packing"]
    assert packed.count() > 0
    with pytest.raises(RuntimeError), common.temporary():
        common.Scratch(spark, "lost").store(spark.range(3), "t")
        raise RuntimeError
    assert os.listdir(run_dir) == ["0"]


def test_run_and_registration(spark):
    packed = corpus_pipeline.run(spark, SF)
    assert set(packing.pack(edge_documents(spark)).columns) == set(packed.columns)
    names = spark_entry.queries()
    assert "pipeline" in names
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14))


def test_edge_rows_pass_all_stages(spark):
    docs = edge_documents(spark)
    for source in (docs, docs.limit(0)):
        left = source
        for _, stage in corpus_pipeline.STAGES[:-1]:
            left = stage(spark, left, SF)
            assert left.columns == docs.columns
        left = left.collect()
    kept = ngram_join.deduplicate(docs).count()
    assert kept == 10 and left == []


def test_columns_may_have_the_names_of_results(spark):
    names = "score lang_pred spans items n_words n_hit contaminated c0 c1 c9 name key shard unit row_id".split()
    rows = [(str(i), f"Document number {i} speaks of the weather and of the sea. " * 3, "en", "s", 0, *names) for i in range(6)]
    docs = spark.createDataFrame([*rows, rows[0]], ["doc_id", "text", "lang", "source", "n_chars", *names])
    left = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, SF)
        assert left.columns == docs.columns
        assert all(tuple(r)[5:] == tuple(names) for r in left.collect())
    assert left.count() > 0
    assert corpus_pipeline.packing_stage(spark, left, SF).count() > 0
