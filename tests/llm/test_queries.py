"""The registered queries: against their SQL where there is one, and the pipeline stage by stage."""

import pytest
from helpers import SF
from oracle import connect, difference

import __spark_entry__ as entry
import corpus_pipeline
from txnlens.llm import queries


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, name):
    got = queries.QUERIES[name](spark, SF).toPandas()
    assert len(got)
    if name in queries.SQL:
        assert difference(got, connect(SF).execute(queries.SQL[name]).df()) is None


def test_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, SF).cache()
        sizes.append(docs.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns and docs.select("doc_id").exceptAll(before.select("doc_id")).isEmpty()
        if name == "quality classifier":
            clean = labels.where("quality = 1").join(before, "doc_id").select("doc_id")
            assert clean.join(docs, "doc_id", "left_anti").count() <= 0.02 * clean.count()
    assert sizes[4] == sizes[3] < sizes[2] < sizes[1] < sizes[0]
    assert docs.where("offset + length > 1024").isEmpty()
    assert corpus_pipeline.run(spark, SF).count() == sizes[-1]
