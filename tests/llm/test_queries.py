"""Registered queries of the pipeline: against their SQL, and the pipeline as a whole."""

import pytest

import __spark_entry__
import corpus_pipeline
from check_oracle import as_rows, duckdb_tables
from webloom.llm import decontam, forest_join, langid
from webloom.llm.queries import QUERIES


def test_registered():
    names = __spark_entry__.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_query_equals_sql(spark, sf_dir, name):
    result = QUERIES[name].build(spark, sf_dir)
    found = duckdb_tables(sf_dir).execute(QUERIES[name].sql)
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(result.columns)
    assert as_rows(result.columns, result.collect()) == as_rows(columns, found.fetchall())


def test_pipeline(spark, sf_dir):
    result = corpus_pipeline.run(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = docs.join(spark.createDataFrame([(r["doc_id"],) for r in result], "doc_id bigint"), "doc_id")
    assert len(result) == kept.count() == len({r["doc_id"] for r in result})
    assert kept.count() < docs.count()
    classes = forest_join.similarity_classes(kept)
    assert classes.where("n_copies > 1 or n_links > 0").count() == 0
    assert decontam.contamination(kept, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where("contaminated").count() == 0
    assert langid.identify(docs).where("lang_pred = 'und'").join(kept, "doc_id").count() == 0
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    clean = labels.where("quality = 1 and toxic = 0")
    before = corpus_pipeline.drop_contaminated(
        spark, corpus_pipeline.drop_near_duplicates(spark, docs, sf_dir), sf_dir
    ).join(clean, "doc_id")
    assert before.join(kept, "doc_id", "left_semi").count() >= 0.95 * before.count()
