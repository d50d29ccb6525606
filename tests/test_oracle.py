"""Each registered query against DuckDB on the same tables."""

import pytest

import __spark_entry__ as entry_point
from tests import oracle

QUERIES, SQL = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck(folder):
    return oracle.connect(folder)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, folder, duck, name):
    frame = QUERIES[name](spark, folder)
    types, expected = oracle.duck_rows(duck, SQL[name])
    assert dict(frame.dtypes) == types
    actual = oracle.spark_rows(frame)
    assert len(actual) == len(expected)
    assert actual == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, folder, name):
    assert QUERIES[name](spark, folder).limit(1).count() == 1


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry_point.entry(spark).count() == 5
