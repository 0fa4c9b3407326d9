"""Every registered query against its DuckDB statement on the small tables."""

import compare
import pytest

import __spark_entry__ as registered

QUERIES = registered.queries()
STATEMENTS = registered.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return compare.duck(small)


def test_only_recursive_chunking_has_no_statement():
    optional = {*registered.llm.QUERIES, "pipeline"} if registered.llm else set()
    assert set(QUERIES) - set(STATEMENTS) - optional == {"chunk_recursive"} and set(STATEMENTS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_query_equals_statement(spark, small, con, name):
    got, want = compare.spark_rows(QUERIES[name](spark, small)), compare.duck_rows(con, STATEMENTS[name])
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1]) > 0
    assert got[1] == want[1]


def test_entry(spark):
    df = registered.entry(spark)
    assert df.columns == ["country", "total_revenue_usd"] and df.count() > 0
