"""Registered queries against their SQL; the pipeline's contract."""

import pytest
from parity import connect, differences

import corpus_pipeline
from orderlens.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) == []


def test_names_are_numbered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before, ids = docs.count(), set()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, sf_dir)
        assert found.columns == docs.columns and found.dtypes == docs.dtypes, name
        docs = corpus_pipeline.keep(found, "test")
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        assert 0 < len(ids) == docs.count() <= before
        before = len(ids)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {r.doc_id for r in last} == ids
    assert all(r.n_pieces == len(r.ids) for r in last)


def test_pipeline_of_an_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.keep(stage(spark, docs, sf_dir), "empty")
        assert docs.count() == 0
