"""The pipeline's stages keep columns and take effect; every query runs."""

import pytest

import corpus_pipeline as pipeline
from scorewell.llm.common import staged
from scorewell.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, docs.count()
    for name, stage in pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, SF), name)
        assert docs.columns == columns and 0 < docs.count() <= kept
        kept = docs.count()
    out = pipeline.STAGES[-1][1](spark, docs, SF)
    assert out.select("doc_id").distinct().count() == kept


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in pipeline.STAGES:
        docs = staged(stage(spark, docs, SF), name) if name != "packing" else stage(spark, docs, SF)
        assert docs.count() == 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_covers_its_table(spark, name):
    table, key = {"op10": ("pages", "page_id"), "op11": ("embeddings", "vec_id")}.get(name.split("_")[0], ("documents", "doc_id"))
    got, rows = QUERIES[name](spark, SF), spark.read.parquet(f"{SF}/{table}.parquet")
    if name.startswith("op12"):  # counts: the first step of an order keeps or removes every row
        first = got.where("filter_order = 'ABCDE' and step = 1").selectExpr("sum(kept + removed)").first()[0]
        assert first == rows.count() and got.select("part").distinct().count() == rows.select("source").distinct().count()
    else:
        assert got.select(key).distinct().count() == rows.count()
    assert set(ORACLE) <= set(QUERIES)
