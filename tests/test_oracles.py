"""Every registered query against its SQL counterpart in DuckDB."""

from __future__ import annotations

import os

import pytest

import __spark_entry__
from compare import connect, duckdb_rows, spark_rows
from stockweave.plans.oracles import ORACLES
from stockweave.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= __spark_entry__.queries().items()
    assert ORACLES.items() <= __spark_entry__.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, name):
    columns, rows = spark_rows(QUERIES[name](spark, SF_DIR))
    expected_columns, expected = duckdb_rows(duck, ORACLES[name])
    assert columns == expected_columns
    assert len(rows) == len(expected)
    assert rows == expected
    assert rows
    for left, right in zip(rows[:1], expected[:1], strict=True):
        assert [type(value) for value in left] == [type(value) for value in right]


def test_the_prefix_before_the_first_bad_cell_is_most_of_the_feed(duck):
    total = duck.execute("select count(*) from events").fetchone()[0]
    kept = duck.execute(f"select count(*) from ({ORACLES['vend_positional']})").fetchone()[0]
    assert 0.9 * total <= kept < total


def test_entry(spark):
    result = __spark_entry__.entry(spark)
    assert result.columns == ["sku", "item", "qty", "band"]
    assert result.count() > 0
