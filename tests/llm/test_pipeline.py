import os
from collections import Counter
from pathlib import Path

import pytest
from brute import exact, near
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import mixing, toxicity
from tidemark.llm.common import documents, labels

SF = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))
pytestmark = pytest.mark.skipif(not SF.exists(), reason="no test tables")


def test_stages_against_plain_versions(spark):
    sf, docs = str(SF), documents(spark, str(SF))
    steps = dict(corpus_pipeline.STAGES)
    clean = steps["toxicity"](spark, docs, sf).cache()
    marked = toxicity.scored(docs.select("doc_id", "text"), toxicity.fit(docs, labels(spark, sf)))
    assert {r[0] for r in clean.select("doc_id").collect()} == {r[0] for r in marked.filter("tox_score < 0.5").select("doc_id").collect()}
    assert clean.columns == docs.columns
    once = steps["exact_dedup"](spark, clean, sf).cache()
    assert sorted(r[0] for r in once.select("doc_id").collect()) == sorted(i for i, _, _, kept, _ in exact([tuple(r) for r in clean.select("doc_id", "text").collect()]) if kept)
    apart = steps["near_dedup"](spark, once, sf).cache()
    assert sorted(r[0] for r in apart.select("doc_id").collect()) == sorted({c for _, _, c in near([tuple(r) for r in once.select("doc_id", "text").collect()])})
    mixed = steps["mixing"](spark, apart, sf).cache()
    plan = {r["doc_id"]: r["copies"] for r in mixing.mixture_plan(apart).collect() if r["copies"]}
    assert dict(Counter(r[0] for r in mixed.select("doc_id").collect())) == plan and mixed.columns == docs.columns
    pieces = steps["packing"](spark, mixed, sf)
    per_doc = {r["doc_id"]: r for r in pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t")).collect()}
    assert set(per_doc) == set(plan) and all(per_doc[i]["n"] == plan[i] * per_doc[i]["t"] for i in plan)


def test_run_is_the_chain_and_handles_empty_tables(spark, tmp_path):
    whole = corpus_pipeline.run(spark, str(SF))
    assert whole.columns[:3] == ["doc_id", "start", "length"] and whole.count() > 0
    documents(spark, str(SF)).limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    labels(spark, str(SF)).limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_odd_rows_and_clashing_columns_pass_through_every_stage(spark):
    """Nulls anywhere, empty and long texts, ties, repeated rows, and columns with the names that operators use inside."""
    sf, given = str(SF), documents(spark, str(SF))
    base = given.limit(60).collect()
    long_text = " ".join(f"long{k % 977}" for k in range(30000))
    rows = [tuple(r) for r in base] + [tuple(base[3]), tuple(base[3]), (None, "a text without an id", None, None, None), (None, None, None, None, None), (90001, None, "en", None, 0), (90002, "", None, "s", 0), (90003, long_text, "en", "s", len(long_text)), (90004, long_text + " end", "en", "s", None), (90005, base[5]["text"], None, None, None)]
    docs = spark.createDataFrame(rows, given.schema)
    clash = ["__id", "__keep", "__sha", "__source", "__rate", "__copy", "tox_score", "id", "dig", "body", "n", "sig", "size", "rate", "target", "copies", "__copy_"]
    docs = docs.select("*", *[F.lit(i).alias(c) for i, c in enumerate(clash)])
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, sf).cache()
        assert kept.columns == docs.columns and kept.count() > 0, name
        assert kept.select(*clash).distinct().count() == 1
        if name != "mixing":
            assert kept.count() <= docs.count()
        if name == "exact_dedup":
            assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.select("doc_id").collect()).count((False, base[3]["doc_id"])) <= 1
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept, sf)
    ids = {r[0] for r in kept.select("doc_id").collect()}
    assert {r[0] for r in pieces.select("doc_id").collect()} == ids
    assert 90004 not in {r[0] for r in kept.select("doc_id").collect()}  # a near copy of 90003
