"""Stages in order on a small corpus, and the registered queries that SQL can express."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from duelframe.llm import decontam, lines, minhash, quality
from duelframe.llm.queries import ORACLES, QUERIES


def test_stage_order_and_columns(spark, sf_dir):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "line dedup", "MinHash near-dedup", "benchmark decontamination", "byte-level BPE"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, docs
    from duelframe.session import stage

    for name, function in corpus_pipeline.STAGES[:-1]:
        after = stage(function(spark, before, sf_dir), "stage-test")
        assert after.columns == columns
        ids = {r.doc_id for r in before.select("doc_id").collect()}
        kept = {r.doc_id for r in after.select("doc_id").collect()}
        assert kept <= ids
        if name == "quality classifier":
            model = quality.fit(before, spark.read.parquet(f"{sf_dir}/labels.parquet"))
            assert kept == {r.doc_id for r in quality.score(before, model).where("score >= 0.5").collect()}
        elif name == "line dedup":
            rows = {r.doc_id: r for r in lines.deduplicated(before).collect()}
            assert kept == {d for d, r in rows.items() if r.n_removed == 0 or r.text.strip()}
            assert {r.doc_id: r.text for r in after.collect()} == {d: rows[d].text for d in kept}
            assert after.where(F.col("n_chars") != F.length("text")).count() == 0
        elif name == "MinHash near-dedup":
            assert kept == {r.doc_id for r in minhash.near_duplicates(before, 5, 80).where("kept").collect()}
        else:
            bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
            leaked = {r.doc_id for r in decontam.leaks(before, bench).collect()}
            assert kept == ids - leaked and leaked
        before = after
    last = corpus_pipeline.STAGES[-1][1](spark, before, sf_dir)
    assert last.count() == before.count() and "n_tokens" in last.columns


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, sf_dir, name):
    from check import compare, connect

    assert compare(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]).startswith("ok")


def test_every_operator_is_registered():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))
    assert duckdb is not None
