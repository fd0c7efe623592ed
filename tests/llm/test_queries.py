"""Registered queries against their SQL, and the pipeline against its stages by brute force."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import cases
import corpus_pipeline
import oracle
from medalytics.llm import catalog

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, name):
    oracle.compare(entry.queries()[name](spark, FOLDER), oracle.connect(FOLDER), catalog.ORACLES[name])


def test_every_operator_has_one_query():
    assert sorted(n.split("_")[0] for n in catalog.QUERIES) == sorted(f"op{i}" for i in range(1, 14))
    assert "pipeline" in entry.queries()


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    known = stages["language ID"](spark, docs, FOLDER)
    assert known.columns == docs.columns and known.count() == docs.count()  # all documents have letters
    lined = stages["line dedup"](spark, known, FOLDER)
    assert lined.columns == docs.columns and lined.filter(F.length("text") != F.col("n_chars")).count() == 0
    single = stages["near-dedup"](spark, lined, FOLDER)
    rows = {r.doc_id: cases.brute_set(r.text) for r in lined.collect()}
    part = cases.groups(sorted(rows), lambda a, b: cases.alike(rows[a], rows[b]))
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(part.values()))
    mixed = stages["mixing sources"](spark, single, FOLDER)
    assert mixed.columns == docs.columns
    final = stages["SentencePiece"](spark, mixed, FOLDER)
    assert final.count() == mixed.count() and final.filter("NOT lossless").count() == 0
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, FOLDER).collect()) == sorted(r.doc_id for r in final.collect())


def test_pipeline_of_awkward_and_no_documents(spark):
    for docs in (cases.awkward(spark), cases.empty(spark)):
        for _, step in corpus_pipeline.STAGES[:-1]:
            docs = step(spark, docs, FOLDER)
            assert docs.columns == cases.empty(spark).columns
        corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count()
