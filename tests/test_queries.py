"""Every registered query against its SQL on the smallest tables, and the shape of its plan."""

import pytest

import __spark_entry__
from check_oracle import compare, duckdb_tables
from webloom.plans import QUERIES

# Queries without SQL: sequential or library algorithms and functions DuckDB does not have. They
# are tested against brute force elsewhere.
NO_SQL = {
    "stem_terms", "build_index_stemmed", "boolean_query_stemmed", "minhash_sketch5", "near_dup_pairs5",
    "mf_dsgd", "mf_als",
}


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duckdb_tables(sf_dir)


def test_registry():
    assert {n for n, q in QUERIES.items() if q.sql is None} == NO_SQL
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) & set(QUERIES) == set(QUERIES) - NO_SQL


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, sf_dir, name):
    matches, report = compare(spark, connection, name, sf_dir)
    assert matches is not False, report


# Iterative builders run their rounds eagerly; their steps are looked at through the others.
@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"mf_dsgd", "mf_als", "crawl_closure"}))
def test_plan_has_no_cross_product(spark, sf_dir, name):
    plan = QUERIES[name].build(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns == ["query_id", "doc_id"]
