"""Registered queries: SQL where there is some, and the pipeline."""

import pytest

import __spark_entry__ as E
import corpus_pipeline
from logweave.llm import registry
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.oracle import compare


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_matches_sql(spark, name):
    assert compare(spark, registry.QUERIES[name], registry.SQL[name], SF_ORACLE) > 0


def test_all_operators_are_registered():
    names = E.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13 and "pipeline" in names


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(stage(spark, docs, SF_SMALL), f"t-{name}")
        counts.append(docs.count())
        if name != "packing":
            assert docs.columns == columns
        if name == "mixing":
            words = docs.selectExpr("sum(regexp_count(text, '[^ \\\\t-\\\\r]+')) AS n").first()["n"]
    quality, lines, near, mixing, packing = counts[1:]
    assert 0 < near < lines == quality < counts[0] and mixing > near and packing >= mixing and words > 0
    for name, stage in corpus_pipeline.STAGES:  # an empty table passes through all stages
        empty = stage(spark, spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0), SF_SMALL)
        assert empty.count() == 0, name
