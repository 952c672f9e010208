"""Completeness, history, alerts."""

from __future__ import annotations

from decimal import Decimal

import pytest

from siftledger.plans import quality
from siftledger.plans.checks import schema_problems
from siftledger.schemas import COMPLETENESS, RUN_AUDIT


def metrics_row(spark, received, modelled, quarantined, pct):
    return spark.createDataFrame(
        [(received, modelled, quarantined, Decimal(str(pct)))],
        "rows_received long, rows_modelled long, rows_quarantined long, quarantine_pct decimal(28,1)",
    )


@pytest.mark.parametrize(
    ("numbers", "threshold", "events"),
    [
        ((100, 71, 29, 29.0), 40, []),
        ((100, 40, 60, 60.0), 40, ["dq_quarantine_high"]),
        ((100, 71, 20, 20.0), 40, ["dq_reconcile_failed"]),
        ((100, 60, 40, 40.0), 40, []),  # the threshold itself raises nothing
        ((100, 10, 60, 60.0), 40, ["dq_reconcile_failed", "dq_quarantine_high"]),
        ((100, 60, 40, 40.0), 39.95, ["dq_quarantine_high"]),
    ],
)
def test_alert_policy(spark, numbers, threshold, events):
    raised = quality.alert_events(metrics_row(spark, *numbers), threshold)
    assert [r.event for r in raised.collect()] == events


def test_alert_record(spark):
    events = quality.alert_events(metrics_row(spark, 100, 40, 60, 60.0))
    record = quality.alerts(events, "job", "task", "r1").first()
    assert record.asDict() == {
        "event": "dq_quarantine_high", "job": "job", "task": "task", "run_id": "r1",
        "message": "quarantine_pct=60.0 threshold=40.0",
    }


def test_completeness_counts_three_relations(spark):
    metrics = quality.completeness(spark.range(18), spark.range(5), spark.range(13))
    assert schema_problems(metrics, COMPLETENESS) == []
    assert tuple(metrics.first()) == (18, 5, 13, True, Decimal("72.2"))
    lost = quality.completeness(spark.range(18), spark.range(5), spark.range(12)).first()
    assert not lost.reconciles and lost.quarantine_pct == Decimal("66.7")


def test_completeness_of_an_empty_feed(spark):
    none = spark.range(0)
    metrics = quality.completeness(none, none, none)
    assert tuple(metrics.first()) == (0, 0, 0, True, None)
    assert quality.alert_events(metrics).collect() == []


@pytest.fixture(scope="module")
def reasons(spark):
    quarantine = spark.sql(
        "SELECT * FROM VALUES ('1', array('price_not_numeric', 'tax_negative'), TIMESTAMP'2024-01-01'), "
        "('2', array('price_not_numeric'), TIMESTAMP'2024-01-01') "
        "AS t(transaction_id_raw, dq_reasons, _quarantined_at)"
    )
    return quality.quarantine_reasons(quarantine)


def test_reasons_and_counts(reasons):
    assert reasons.count() == 3
    assert {tuple(r) for r in quality.reason_counts(reasons).collect()} == {
        ("price_not_numeric", 2), ("tax_negative", 1),
    }


def test_run_audit_and_history(spark, reasons):
    metrics = quality.completeness(spark.range(3), spark.range(1), spark.range(2))
    audit = quality.run_audit(metrics, reasons, "r1", "2024-01-01 00:00:00")
    assert schema_problems(audit, RUN_AUDIT) == []
    row = audit.first()
    assert (row.rows_received, row.n_price_not_numeric, row.n_tax_not_numeric) == (3, 2, 0)
    assert quality.not_yet_recorded(audit, audit, "invocation_id").count() == 0
    other = quality.run_audit(metrics, reasons, "r2", "2024-01-01 00:00:00")
    assert quality.not_yet_recorded(other, audit, "invocation_id").count() == 1


def test_summary_is_ordered(spark, reasons):
    metrics = quality.completeness(spark.range(3), spark.range(1), spark.range(2))
    lines = [tuple(r) for r in quality.run_summary(metrics, reasons).collect()]
    assert lines == [
        ("rows", "rows_received", 3), ("rows", "rows_quarantined", 2), ("rows", "rows_modelled", 1),
        ("reason", "price_not_numeric", 2), ("reason", "tax_negative", 1),
    ]
