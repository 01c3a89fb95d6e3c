"""Registered queries against their SQL twins, and the pipeline stage by stage."""

from __future__ import annotations

import pytest
from conftest import SF001
from oracle_check import compare, duck

import corpus_pipeline
from clickweave.llm import language, packing, queries, repeats, simhash


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    res = compare(spark, duck(SF001), name, queries.QUERIES[name], queries.ORACLE_SQL[name], SF001)
    assert res["status"] == "match", res


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_pipeline_stages(spark, scratch):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").withColumn("size", language.held_out())
    columns, kept = docs.columns, [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, kept[-1], SF001)
        out.write.parquet(f"{scratch}/{i}")
        kept.append(spark.read.parquet(f"{scratch}/{i}"))
        assert i == 4 or out.columns == columns
    known = language.identify(docs).where("lang_pred <> 'und'").count()
    assert kept[1].count() == known
    groups = simhash.near_duplicates(kept[1]).select("component_id").distinct().count()
    assert kept[2].count() == groups
    gone = repeats.report(kept[2]).selectExpr("sum(n_removed)").first()[0]
    assert kept[3].count() == groups and gone > 0
    assert repeats.report(kept[3]).selectExpr("sum(n_bytes)").first()[0] >= repeats.report(kept[2]).selectExpr("sum(n_bytes)").first()[0] - gone
    assert kept[5].select("doc_id").distinct().count() == kept[4].select("doc_id").distinct().count()
    assert kept[5].count() == packing.pieces(kept[4]).count()


def test_pipeline_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF001)
    assert docs.count() == 0
