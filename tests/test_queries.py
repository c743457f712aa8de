"""Every registered query against its SQL on the smallest tables."""

import pytest
from oracle import FOLDER, compare, connect

import __spark_entry__ as registered

#: the catalogue's; the operators of ``docsearch/llm`` have tests of their own
QUERIES, SQL = registered.QUERIES, registered.SQL


@pytest.fixture(scope="module")
def base():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, base, name):
    assert compare(QUERIES[name](spark, FOLDER), base, SQL[name]) is None


def test_entry(spark):
    frame = registered.entry(spark)
    assert frame.columns == ["doc_id", "score"] and frame.count() > 0
