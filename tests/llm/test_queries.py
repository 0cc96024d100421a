"""Registered queries and the pipeline on the smallest tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from checks import compare
from partledger.llm import jaccard, registered
from partledger.llm.common import read_table

TABLES = "/root/testdata/sf0.001"
QUERIES, SQL = registered.queries(), registered.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return compare.connect(TABLES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert compare.compare(QUERIES[name](spark, TABLES), SQL[name], con) == []


@pytest.mark.parametrize("name", [q for q in QUERIES if q not in SQL and q != "pipeline"])
def test_query_covers_its_table(spark, name):
    result = QUERIES[name](spark, TABLES)
    assert result.count() == read_table(spark, TABLES, "documents").count()


def test_held_out_accuracy(spark):
    labels = read_table(spark, TABLES, "labels").select("doc_id", "toxic")
    toxic = registered.op5_toxicity(spark, TABLES).join(labels, "doc_id")
    wrong = toxic.filter("predicted <> toxic and toxic = 0").count()
    assert wrong <= 0.05 * toxic.count()
    lang = read_table(spark, TABLES, "documents").select("doc_id", "lang")
    said = registered.op8_language_id(spark, TABLES).join(lang, "doc_id").filter("held_out")
    assert said.filter("lang <> lang_pred").count() <= 0.05 * said.count()


def test_pipeline_stages(spark):
    docs = read_table(spark, TABLES, "documents")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.store(stage(spark, docs, TABLES), f"test-{name}")
        seen[name] = (docs, out)
        if name != "sharding":
            assert out.columns == columns
        docs = out
    before, after = seen["ngram_jaccard"]
    linked = jaccard.similar_documents(before).filter("doc_id = component_id").select("doc_id")
    assert {r[0] for r in linked.collect()} == {r[0] for r in after.select("doc_id").collect()}
    before, after = seen["sharding"]
    assert after.count() == before.count()
    assert after.agg(F.count_distinct("shard")).first()[0] == registered.SHARDS
    assert corpus_pipeline.ORACLE_SQL is None
