"""A whole run: what it writes, publishes, refuses and repeats."""

from __future__ import annotations

from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from siftledger import __main__ as command
from siftledger.plans import aggregates, checks
from siftledger.plans.checks import Severity
from siftledger.plans.run import ChecksFailed, ContractViolation, Options, attach, run
from siftledger.schemas import FACT, NAMESPACES, QUARANTINE, RAW, RAW_COLUMNS
from siftledger.sinks.warehouse import Warehouse

RUN_TS = datetime(2024, 1, 2, 3, 4, 5, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def warehouse(spark, edge_path, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("warehouse"))
    return root, run(spark, edge_path, root, "first", RUN_TS)


def tables(spark):
    return {
        f"{n}.{t.name}": spark.table(f"{n}.{t.name}")
        for n in NAMESPACES
        for t in spark.catalog.listTables(n)
        if not t.isTemporary
    }


def test_acceptance(spark, warehouse):
    """The end state: sizes, keys, formula, references, dimensions, history, shares."""
    _, result = warehouse
    assert result.failed == []
    stored = tables(spark)
    fact = stored["analytics.fct_transactions"]
    assert stored["raw.customer_transactions"].count() == 18
    assert fact.count() == 5
    assert stored["analytics.quarantine_customer_transactions"].count() == 13
    assert stored["analytics.dq_completeness"].first().reconciles
    assert fact.groupBy("transaction_id").count().where("count > 1").isEmpty()
    assert fact.where("total_amount <> quantity * unit_price + tax_amount").isEmpty()
    for dimension, key in (("product", "product_id"), ("customer", "customer_id"), ("date", "date_key")):
        assert fact.join(stored[f"analytics.dim_{dimension}"], key, "left_anti").isEmpty()
    assert stored["analytics.dim_product"].count() == 3
    assert stored["analytics.dim_customer"].count() == 4
    assert stored["analytics.dim_customer"].where("is_unknown").count() == 1
    assert stored["analytics.dq_run_audit"].count() >= 1
    share = stored["analytics.agg_sales_by_product"].agg(F.sum("revenue_share_pct")).first()[0]
    assert abs(share - 100) < 0.5


def test_views(spark, warehouse):
    stored = tables(spark)
    assert set(stored) >= {
        "raw.customer_transactions",
        "staging.stg_customer_transactions",
        "analytics.dim_table",
        "analytics.fact_table",
        "analytics.dq_quarantine_reasons",
        "analytics.dim_date",
        "analytics.agg_monthly_sales",
        "analytics.agg_sales_by_customer",
    }
    assert stored["analytics.fact_table"].columns == FACT.schema.names
    assert stored["analytics.dq_quarantine_reasons"].count() == 15
    staged = stored["staging.stg_customer_transactions"]
    assert dict(staged.dtypes)["is_valid"] == "boolean"
    assert staged.where("is_valid").count() == 5


def test_documentation_is_stored(spark, warehouse):
    described = {r.col_name: r.comment for r in spark.sql("DESCRIBE analytics.fct_transactions").collect()}
    assert described["customer_id"] == "Customer key; -1 when unknown."
    text = "\n".join(str(r) for r in spark.sql("DESCRIBE EXTENDED raw.customer_transactions").collect())
    assert RAW.comment in text


def test_staged_rows_are_divided_by_verdict(warehouse):
    _, result = warehouse
    folder = Path(result.warehouse.path("staging", "stg_customer_transactions"))
    assert {p.name for p in folder.iterdir() if p.is_dir()} == {"is_valid=true", "is_valid=false"}


def test_test_results_and_failing_rows_are_stored(spark, warehouse):
    root, result = warehouse
    assert len(result.checks) == len(checks.declared_checks()) + len(checks.digits_lost_checks()) == 31
    stored = spark.read.parquet(result.warehouse.path("dq_audit", "check_results"))
    assert {r.check: r.status for r in stored.collect()} == {r.check: r.status for r in result.checks}
    warned = [r.check for r in result.checks if r.status == "warn"]
    assert warned == ["quarantine_within_threshold"]
    failing = spark.read.parquet(result.warehouse.path("dq_audit", "quarantine_within_threshold"))
    assert failing.count() == 13 and failing.columns == ["transaction_id_raw", "dq_reasons"]
    assert not Path(root, "dq_audit", "total_amount_formula").exists()


def test_alerts_and_summary(spark, warehouse):
    root, result = warehouse
    assert [(a.event, a.run_id) for a in result.alerts] == [("dq_quarantine_high", "first")]
    assert spark.read.parquet(f"{root}/analytics/dq_alerts").count() == 1
    lines = {r.item: r.n for r in result.summary.collect()}
    assert lines["rows_received"] == 18 and lines["transaction_id_invalid"] == 4


def test_runs_repeat_without_a_trace(spark, edge_path, tmp_path, caplog):
    root = str(tmp_path)
    compared = ("fct_transactions", "agg_sales_by_product", QUARANTINE.name, RAW.name)

    def rows(result):
        return [sorted(map(str, result.relations[name].collect())) for name in compared]

    with caplog.at_level("WARNING"):
        original = run(spark, edge_path, root, "a", RUN_TS)
    first = rows(original)
    assert any("quality alert" in r.message and "dq_quarantine_high" in r.message for r in caplog.records)
    again = run(spark, edge_path, root, "a", RUN_TS)
    assert again.relations["dq_run_audit"].count() == 1
    assert spark.read.parquet(f"{root}/analytics/dq_alerts").count() == 1
    other = run(spark, edge_path, root, "b", RUN_TS)
    assert {r.invocation_id for r in other.relations["dq_run_audit"].collect()} == {"a", "b"}
    assert first == rows(again) == rows(other)
    assert rows(original) == first  # a repeated run leaves earlier readers their files
    assert attach(spark, root, "a").version == again.warehouse.version
    assert attach(spark, root).version == other.warehouse.version
    with pytest.raises(FileNotFoundError):
        attach(spark, root, "c")


def write_feed(path, *lines):
    path.write_text("\n".join([",".join(RAW_COLUMNS), *lines]) + "\n", encoding="utf-8")
    return str(path)


CLEAN = [f"{i},5.0,2024-01-0{i},7,Widget,1.0,2.00,0.10" for i in range(1, 6)]


def test_injected_faults_move_rows_to_quarantine(spark, tmp_path):
    faults = [
        CLEAN[0],  # both copies of an id are rejected
        "6,5.0,2024-01-06,7,Widget,0,2.00,0.10",
        "7,5.0,2024-01-06,7,Widget,1.0,0,0.10",
    ]
    dirty = run(spark, write_feed(tmp_path / "b.csv", *CLEAN, *faults), str(tmp_path / "w"), "dirty", RUN_TS)
    assert dirty.relations[FACT.name].count() == 4
    assert dirty.relations[QUARANTINE.name].count() == 4
    assert dirty.failed == []


@pytest.mark.parametrize(
    ("line", "problem"),
    [
        ("6,5.0,2024-01-06,,Widget,1.0,2.00,0.10", "product_id_required"),
        ("6,5.0,2024-01-06,7,   ,1.0,2.00,0.10", "product_name_required"),
        ("6,5.0,2024-01-06,7,Gizmo,1.0,2.00,0.10", "dim_product_primary_key"),
    ],
)
def test_contract_violations_publish_nothing(spark, warehouse, tmp_path, line, problem):
    root, _ = warehouse
    attach(spark, root, "first")
    source = write_feed(tmp_path / "b.csv", *CLEAN, line)
    with pytest.raises(ContractViolation, match=problem):
        run(spark, source, root, "bad", RUN_TS)
    assert spark.table("analytics.quarantine_customer_transactions").count() == 13
    assert [r.invocation_id for r in spark.table("analytics.dq_run_audit").collect()] == ["first"]


def test_failed_tests_fail_the_run_after_everything_is_recorded(spark, tmp_path):
    source = write_feed(tmp_path / "a.csv", *CLEAN, "6,5.0,2019-12-31,7,Widget,1.0,2.00,0.10", "x,,,,,,,")
    root = str(tmp_path / "w")
    options = Options(quarantine_severity=Severity(warn_above=0, fail_from=1))
    failed = "quarantine_within_threshold, relationships_fct_transactions_date_key"
    with pytest.raises(ChecksFailed, match=failed):
        run(spark, source, root, "r", RUN_TS, options)
    orphans = spark.read.parquet(f"{root}/dq_audit/relationships_fct_transactions_date_key/run=r/*")
    assert [tuple(r) for r in orphans.collect()] == [(20191231, 1)]
    assert spark.table("analytics.dq_run_audit").count() == 1


def test_bad_sources_stop_before_anything_is_written(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="header"):
        run(spark, str(tmp_path / "bad.csv"), str(tmp_path / "w"), "r", RUN_TS)
    with pytest.raises(FileNotFoundError):
        run(spark, str(tmp_path / "none.csv"), str(tmp_path / "w"), "r", RUN_TS)
    assert not (tmp_path / "w").exists()


def test_command_line(spark, tmp_path, capsys):
    source = write_feed(tmp_path / "a.csv", *CLEAN)
    root = str(tmp_path / "w")
    command.main(["run", source, root, "--run-id", "cli", "--spine-end", "2025-01-01"])
    assert "rows_received" in capsys.readouterr().out
    assert spark.table("analytics.dim_date").count() == 1827
    assert [r.invocation_id for r in spark.table("analytics.dq_run_audit").collect()] == ["cli"]
    command.main(["freshness", root])
    assert "pass" in capsys.readouterr().out
    command.main(["profile", root])
    assert "=== tax_percent_of_subtotal" in capsys.readouterr().out


def test_profile_answers_are_stored_whole(spark, tmp_path, capsys):
    """More rows than are printed."""
    rows = [f"{i},4.0,2024-03-01,9,Lamp,1.0,2.50,0.10" for i in range(1, 31)] * 2
    root = str(tmp_path / "w")
    command.main(["run", write_feed(tmp_path / "a.csv", *rows), root, "--keep-going"])
    capsys.readouterr()
    command.main(["profile", root, "--rows", "5"])
    assert "=== duplicate_ids: 30 rows in " in capsys.readouterr().out
    assert spark.read.parquet(*map(str, Path(root, "dq_audit", "profile_duplicate_ids").glob("*/*"))).count() == 30


def test_history_waits_for_publishing(spark, tmp_path, monkeypatch):
    """A run that cannot publish leaves no history; its retry does."""
    source, root = write_feed(tmp_path / "a.csv", *CLEAN), str(tmp_path / "w")

    def refuse(*args):
        raise OSError("catalog is down")

    with monkeypatch.context() as broken:
        broken.setattr(Warehouse, "publish", refuse)
        with pytest.raises(OSError, match="catalog"):
            run(spark, source, root, "r", RUN_TS)
    assert not Path(root, "analytics", "dq_run_audit").exists()
    run(spark, source, root, "r", RUN_TS)
    assert spark.table("analytics.dq_run_audit").count() == 1


def test_declared_tests_cover_the_contracts(warehouse):
    _, result = warehouse
    assert {c.relation for c in checks.declared_checks()} <= set(result.relations)


def test_monthly_sales_take_the_stored_ids(spark, edge_path, tmp_path, monkeypatch):
    def refused(fact):
        raise AssertionError("not needed by a run")

    monkeypatch.setattr(aggregates, "monthly_sales", refused)
    relations = run(spark, edge_path, str(tmp_path), "months", RUN_TS).relations
    monkeypatch.undo()
    expected = aggregates.monthly_sales(relations[FACT.name])
    stored = relations["agg_monthly_sales"].select(*expected.columns)
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, expected.collect())) != []


def test_a_run_leaves_no_shuffles(spark, edge_path, tmp_path):
    from test_session import shuffle_files

    before = shuffle_files(spark)
    run(spark, edge_path, str(tmp_path / "w"), "one", RUN_TS, Options(strict=False))
    assert shuffle_files(spark) <= before
    stored = list((tmp_path / "w").glob("*/*/run=one/**/part-*.parquet"))
    assert stored and all(".zstd." in p.name for p in stored if "dq_run_audit" not in str(p))
