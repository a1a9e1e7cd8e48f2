"""The registered corpus queries against their SQL, and the pipeline against its parts."""

import pytest
from compare import difference, oracle_connection

import corpus_pipeline
from chargelake.llm import decontaminate, near_dup, secrets
from chargelake.llm.common import table
from chargelake.llm.oracles import ORACLES
from chargelake.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_sql(spark, name):
    assert difference(oracle_connection(SF_DIR), QUERIES[name](spark, SF_DIR), ORACLES[name]) is None


@pytest.mark.parametrize("name", [name for name in QUERIES if name not in ORACLES])
def test_query_runs(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    rows = {"op3": "embeddings"}.get(name.split("_")[0], "documents")
    count = df.count()
    assert count >= (50 if rows == "embeddings" else table(spark, SF_DIR, rows).count())
    assert len(set(df.columns)) == len(df.columns)


def test_stages(spark, documents, odd_rows):
    """Each stage keeps the columns of documents, and the documents that it must."""
    docs = table(spark, SF_DIR, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF_DIR)
        assert kept.columns == docs.columns and kept.count() > 0.5 * docs.count(), name
    everything = documents(odd_rows)
    counts = [stage(spark, everything, SF_DIR).count() for _, stage in corpus_pipeline.STAGES]
    assert counts[0] == 5 and counts[1] == 9 and counts[2] == counts[3] == 10 and counts[4] >= 10
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, everything.limit(0), SF_DIR).count() == 0


def test_result_holds_no_copy_secret_or_benchmark_passage(spark):
    docs = table(spark, SF_DIR, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = near_dup.staged(stage(spark, docs, SF_DIR), "stage")
    assert near_dup.near_duplicates(docs, size=5).filter("key <> component.key").count() == 0
    assert secrets.find_secrets(docs).filter("size(spans) > 0").count() == 0
    found = decontaminate.contamination(docs, table(spark, SF_DIR, "benchmark"))
    assert found.filter("size(places) > 0").count() == 0
    placed = corpus_pipeline.run(spark, SF_DIR)
    assert {r.doc_id for r in placed.collect()} == {r.doc_id for r in docs.collect()}
