"""Every registered query against the same answer from another engine."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registry
import oracles

FOLDER = "/root/testdata/sf0.001"
# The corpus operators have tests of their own, which can be left out with them.
QUERIES = registry.library_queries()
ORACLES = oracles.oracle_sql()

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, database, name):
    frame = QUERIES[name](spark, FOLDER)
    columns = sorted(frame.columns)
    ours = sorted(tuple(str(row[c]) for c in columns) for row in frame.collect())
    answer = database.execute(ORACLES[name])
    names = [column[0] for column in answer.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    theirs = sorted(tuple(str(row[i]) for i in order) for row in answer.fetchall())
    assert ours == theirs


def test_flagship(spark):
    assert registry.entry(spark).count() > 0
