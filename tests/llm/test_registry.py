"""Every corpus query is registered; those with SQL give the same rows as another engine."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


def test_names():
    names = [n for n in registry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in registry.queries()


@pytest.mark.parametrize("name", ["op4_line_runs", "op9_chat_format", "op11_edit_automata", "op12_threshold", "op13_maxscore"])
def test_same_rows(spark, name):
    connection = duckdb.connect()
    for table in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    frame = registry.queries()[name](spark, FOLDER)
    columns = sorted(frame.columns)
    ours = sorted(tuple(str(row[c]) for c in columns) for row in frame.collect())
    answer = connection.execute(registry.oracle_sql()[name])
    names = [column[0] for column in answer.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert ours == sorted(tuple(str(row[i]) for i in order) for row in answer.fetchall())
