"""The feed at scale: what no reader asks for is neither joined nor built."""

from __future__ import annotations

from datetime import datetime

import pytest

import __spark_entry__ as registry
from siftledger.operators.duplicates import mark_repeated, repeated_keys
from siftledger.plans import checks
from siftledger.schemas import DIM_DATE, QUARANTINE
from siftledger.sources.derived import dirty_feed

DAY = datetime(1995, 3, 4)
LINES = [(k, 10 + k % 3, k % 4, 2.0, 10.0, 0.05, DAY) for k in range(1, 30)] + [
    (None, None, 1, 2.0, 10.0, 0.05, DAY)
]


@pytest.fixture
def tables(spark, tmp_path):
    def write(orders, parts):
        lines = spark.createDataFrame(
            LINES,
            "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, "
            "l_extendedprice double, l_tax double, l_shipdate timestamp",
        )
        lines.write.parquet(f"{tmp_path}/lineitem.parquet")
        orders = spark.createDataFrame(orders, "o_orderkey long, o_custkey long")
        orders.write.parquet(f"{tmp_path}/orders.parquet")
        parts = spark.createDataFrame(parts, "p_partkey long, p_name string")
        parts.write.parquet(f"{tmp_path}/part.parquet")
        return str(tmp_path)

    return write


UNIQUE = ([(k, 100 + k) for k in range(1, 25)] + [(None, 7)] * 2, [(10, "a"), (11, "b"), (None, "n")])


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_unread_tables_are_not_joined(spark, tables):
    feed = dirty_feed(spark, tables(*UNIQUE))
    assert "Join" not in plan_of(feed.select("transaction_id"))
    assert plan_of(feed.select("product_name")).count("Join") == 1
    assert feed.count() == feed.select("transaction_id").count() == len(LINES)


def test_missing_keys_meet_nothing(spark, tables):
    rows = dirty_feed(spark, tables(*UNIQUE)).collect()
    missing = [r for r in rows if r.transaction_id is None]
    assert [(r.customer_id, r.product_name) for r in missing] == [(None, None)]
    names = {r.product_id: (r.product_name or "").strip() or None for r in rows}
    assert names == {None: None, "10": "a", "11": "b", "12": None}


def test_keys_that_repeat_multiply_lines(spark, tables):
    orders = [(1, 101), (1, 102), (2, 103)]
    parts = [(10, "a"), (10, "a"), (11, "b")]
    feed = dirty_feed(spark, tables(orders, parts))
    expected = sum(
        max(1, sum(o[0] == l[0] for o in orders)) * max(1, sum(p[0] == l[1] for p in parts))
        for l in LINES
    )
    assert feed.count() == feed.select("transaction_id").count() == expected
    assert {r.customer_id for r in feed.where("transaction_id = '11'").collect()} == {"101.0", "102.0"}


def test_marking_reads_the_columns_asked_for(spark, tmp_path):
    spark.range(400).selectExpr("id % 150 AS key", "id AS row", "'x' AS wide").write.parquet(
        f"{tmp_path}/rows"
    )
    rows = spark.read.parquet(f"{tmp_path}/rows")
    repeated = repeated_keys(rows, "key")
    marked = mark_repeated(rows, "key", repeated, "again", max_broadcast_keys=3, min_hot_rows=1)
    plan = marked.groupBy("again").count()._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" in plan and "wide" not in plan


def test_a_check_builds_only_what_it_reads(spark, tables, monkeypatch):
    def built(*_):
        raise AssertionError("the calendar was built")

    monkeypatch.setattr(registry.marts, "dim_date", built)
    relations = registry.Layers(spark, tables(*UNIQUE)).relations
    chosen = [c for c in checks.declared_checks() if c.relation == QUARANTINE.name]
    assert checks.results(relations, chosen).count() == len(chosen)
    with pytest.raises(AssertionError):
        relations[DIM_DATE.name]
    assert len(relations) == len(list(relations)) == 9


@pytest.mark.parametrize("name", ["check_accepted_values", "check_reconcile"])
def test_counting_rows_stores_none(spark, tables, monkeypatch, name):
    def stored(*_):
        raise AssertionError("whole staged rows were stored")

    monkeypatch.setattr(registry, "materialise", stored)
    (row,) = registry.library_queries()[name](spark, tables(*UNIQUE)).collect()
    assert (row.failures, row.status) == (0, "pass")
