"""Duplicate marking against a count in Python, on every path, with hot and missing keys."""

from __future__ import annotations

from collections import Counter

import pytest

from siftledger.operators.duplicates import mark_repeated, repeated_keys
from siftledger.session import materialise


@pytest.fixture(scope="module")
def rows(spark):
    keys = (
        [1] * 400  # a third of all rows share one key
        + [None] * 300
        + [k for k in range(100, 150) for _ in range(2)]
        + [k for k in range(200, 210) for _ in range(7)]
        + list(range(1000, 1330))
    )
    return spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "row int, key long")


def brute_force(rows):
    found = rows.collect()
    counts = Counter(r.key for r in found if r.key is not None)
    return {r.row: counts[r.key] > 1 for r in found}


@pytest.mark.parametrize(
    "limits",
    [
        {},
        {"max_broadcast_keys": 10, "min_hot_rows": 5},  # hot keys broadcast, the rest shuffled
        {"max_broadcast_keys": 1, "min_hot_rows": 1},
        {"max_broadcast_keys": 10, "min_hot_rows": 10_000},  # no hot key
    ],
    ids=["broadcast", "hot-and-light", "tight", "light-only"],
)
def test_every_path_marks_the_same_rows(rows, limits):
    repeated = materialise(repeated_keys(rows, "key"), "test-repeated")
    marked = mark_repeated(rows, "key", repeated, "again", **limits)
    assert marked.columns == ["row", "key", "again"]
    assert {r.row: r.again for r in marked.collect()} == brute_force(rows)
    assert marked.count() == rows.count()


def test_repeated_keys_counts_rows(rows):
    counts = {r.key: r.n_rows for r in repeated_keys(rows, "key").collect()}
    assert counts[1] == 400 and counts[200] == 7 and counts[100] == 2
    assert None not in counts and 1000 not in counts


def test_hot_keys_fit_the_broadcast(rows):
    """Whatever the minimum, no more keys than the limit are hot."""
    repeated = materialise(repeated_keys(rows, "key"), "test-repeated")
    plan = mark_repeated(rows, "key", repeated, "again", max_broadcast_keys=3, min_hot_rows=1)
    assert {r.row: r.again for r in plan.collect()} == brute_force(rows)
    total = repeated.agg({"n_rows": "sum"}).first()[0]
    assert repeated.where(f"n_rows >= {total // 3 + 1}").count() <= 3


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_are_not_shuffled_when_keys_are_few(rows):
    repeated = materialise(repeated_keys(rows, "key"), "test-repeated")
    plan = plan_of(mark_repeated(rows, "key", repeated, "again"))
    assert "BroadcastHashJoin" in plan
    assert "Window" not in plan and "hashpartitioning" not in plan


def test_large_path_reads_the_rows_once(spark, tmp_path):
    """One scan, and one shuffle of the rows at most, beside that of the repeated keys."""
    spark.range(400).selectExpr("id % 150 AS key", "id AS row").write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    repeated_keys(rows, "key").write.parquet(str(tmp_path / "repeated"))
    repeated = spark.read.parquet(str(tmp_path / "repeated"))
    marked = mark_repeated(rows, "key", repeated, "again", max_broadcast_keys=3, min_hot_rows=1)
    plan = plan_of(marked)
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert sum("n_rows" not in line for line in scans) == 1 and "Union" not in plan
    assert {r.row: r.again for r in marked.collect()} == brute_force(rows)
