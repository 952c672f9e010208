"""One run of the warehouse: land, judge, build, verify, publish, test, report.

Scans at scale: the source twice (landing and independent count), the landed ids once,
the landed rows once into ``staged``, which is split by verdict so that everything
after it reads only its half. Only counts, test results and alerts reach the driver.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession

from siftledger import schemas
from siftledger.operators import key_counts
from siftledger.plans import aggregates, checks, marts, quality, staging
from siftledger.plans.checks import Check, Severity
from siftledger.session import shuffles_removed, shuffles_sized_for
from siftledger.sinks.warehouse import Warehouse
from siftledger.sources import delimited

log = logging.getLogger(__name__)

JOB = "transactions"
REPORT_TASK = "dq_report"
CONCURRENT_TABLES = 4

PUBLISHED = (
    schemas.RAW,
    schemas.STAGED,
    schemas.DIM_PRODUCT,
    schemas.DIM_CUSTOMER,
    schemas.DIM_DATE,
    schemas.FACT,
    schemas.QUARANTINE,
    schemas.COMPLETENESS,
    schemas.MONTHLY_SALES,
    schemas.MONTHLY_IDS,
    schemas.SALES_BY_CUSTOMER,
    schemas.SALES_BY_PRODUCT,
)
LOGS = (schemas.RUN_AUDIT,)
VIEWS = {
    "analytics.dim_table": "SELECT * FROM analytics.dim_product",
    "analytics.fact_table": (
        f"SELECT {', '.join(schemas.FACT.schema.names)} FROM analytics.fct_transactions"
    ),
    "analytics.dq_quarantine_reasons": (
        "SELECT transaction_id_raw, explode(dq_reasons) AS dq_reason, _quarantined_at "
        "FROM analytics.quarantine_customer_transactions"
    ),
}


class ContractViolation(ValueError):
    """A table does not meet its declared contract; nothing was published."""


class ChecksFailed(ValueError):
    """Tables are published and results stored, but tests of error severity failed."""


@dataclass(frozen=True)
class Options:
    """Parameters of a run; the defaults suit a small feed from 2020 on."""

    spine: tuple[str, str] = (marts.SPINE_START, marts.SPINE_END)
    quarantine_alert_pct: float = quality.DEFAULT_QUARANTINE_ALERT_PCT
    quarantine_severity: Severity = field(default=Severity(warn_above=0, fail_from=50))
    multi_line: bool = False
    strict: bool = True
    # Whether tables are published although tests of error severity failed.
    publish_failing: bool = True
    # Buckets of the id counts that batches keep; the same for all batches of a warehouse.
    index_buckets: int = key_counts.BUCKETS


@dataclass(frozen=True)
class RunReport:
    warehouse: Warehouse
    relations: Mapping[str, DataFrame]
    checks: list[Row]
    alerts: list[Row]
    summary: DataFrame | None

    @property
    def failed(self) -> list[str]:
        return [row["check"] for row in self.checks if row["status"] == "fail"]


def run(
    spark: SparkSession,
    source: str,
    root: str,
    run_id: str,
    run_ts: datetime,
    options: Options = Options(),
) -> RunReport:
    """Build every relation from the delimited files at ``source`` under ``root``.

    Repeating a run with the same ``run_id`` publishes fresh tables and adds no history.
    """
    warehouse = Warehouse(spark, root, run_id)
    with shuffles_removed(spark):
        raw = land(warehouse, source, run_ts, options.multi_line)
        with shuffles_sized_for(raw):
            result = _build_and_report(warehouse, raw, run_ts, options)
    if options.strict and result.failed:
        raise ChecksFailed(f"run {run_id}: {', '.join(result.failed)}")
    return result


def _build_and_report(
    warehouse: Warehouse, raw: DataFrame, run_ts: datetime, options: Options
) -> RunReport:
    declared = checks.declared_checks(options.quarantine_severity) + checks.digits_lost_checks()
    relations = build(warehouse, raw, run_ts, options.spine, declared)
    enforce_columns(relations)
    relations |= summarise(warehouse, relations, declared)
    audit = quality.run_audit(
        relations[schemas.COMPLETENESS.name], relations[checks.REASONS], warehouse.run_id, run_ts
    )
    outcome = test(warehouse, relations | {schemas.RUN_AUDIT.name: audit}, declared)
    result = RunReport(warehouse, relations, outcome, [], None)
    if not options.publish_failing and result.failed:
        raise ChecksFailed(f"run {warehouse.run_id}, not published: {', '.join(result.failed)}")

    # History is appended once the tables are published: a run that fails before leaves none.
    warehouse.publish(PUBLISHED, VIEWS)
    relations |= note_in_history(warehouse, audit)
    warehouse.show_logs(LOGS)
    raised = report(warehouse, relations, options.quarantine_alert_pct)
    summary = quality.run_summary(relations[schemas.COMPLETENESS.name], relations[checks.REASONS])
    return RunReport(warehouse, relations, outcome, raised, summary)


def land(warehouse: Warehouse, source: str, run_ts: datetime, multi_line: bool) -> DataFrame:
    """Full replace of the raw table, reconciled with a separate count of the source."""
    spark = warehouse.spark
    delimited.validate_header(spark, source)
    expected = delimited.count_data_rows(spark, source, multi_line)
    raw = warehouse.store(schemas.RAW, delimited.read_source(spark, source, run_ts, multi_line))
    delimited.reconcile(expected, raw)
    return raw


def build(
    warehouse: Warehouse,
    raw: DataFrame,
    run_ts: datetime,
    spine: tuple[str, str],
    declared: Sequence[Check] = (),
) -> dict[str, DataFrame]:
    """Staged rows, star schema and quarantine; tests of single rows count as they are written."""
    repeated = warehouse.write(
        staging.repeated_transaction_ids(raw), "staging", "repeated_transaction_ids"
    )
    built = _together(
        warehouse, {schemas.STAGED: lambda: staging.staged(raw, repeated, stored=True)}, declared
    )
    staged = built[schemas.STAGED.name]
    valid = marts.valid_transactions(staged)
    built |= _together(
        warehouse,
        {
            schemas.FACT: lambda: marts.fct_transactions(valid),
            schemas.QUARANTINE: lambda: marts.quarantine(staged, run_ts),
            schemas.DIM_PRODUCT: lambda: marts.dim_product(valid),
            schemas.DIM_CUSTOMER: lambda: marts.dim_customer(valid),
            schemas.DIM_DATE: lambda: marts.dim_date(warehouse.spark, *spine),
        },
        declared,
    )
    built |= {schemas.RAW.name: raw}
    built[checks.REASONS] = quality.quarantine_reasons(built[schemas.QUARANTINE.name])
    return built


def enforce_columns(relations: Mapping[str, DataFrame]) -> None:
    """Raise unless every contracted table has its columns and types."""
    problems = [
        problem
        for contract in schemas.CONTRACTS
        for problem in checks.schema_problems(relations[contract.name], contract)
    ]
    if problems:
        raise ContractViolation("; ".join(problems))


def summarise(
    warehouse: Warehouse, relations: Mapping[str, DataFrame], declared: Sequence[Check] = ()
) -> dict[str, DataFrame]:
    """Sales summaries and completeness."""
    fact = relations[schemas.FACT.name]
    products = relations[schemas.DIM_PRODUCT.name]
    built = _together(
        warehouse,
        {
            schemas.MONTHLY_IDS: lambda: aggregates.monthly_ids(fact),
            schemas.SALES_BY_CUSTOMER: lambda: aggregates.sales_by_customer(fact),
            schemas.SALES_BY_PRODUCT: lambda: aggregates.sales_by_product(fact, products),
            schemas.COMPLETENESS: lambda: quality.completeness(
                relations[schemas.RAW.name], fact, relations[schemas.QUARANTINE.name]
            ),
        },
        declared,
    )
    ids = built[schemas.MONTHLY_IDS.name]
    return built | _together(
        warehouse,
        {schemas.MONTHLY_SALES: lambda: aggregates.monthly_sales_of(fact, ids)},
        declared,
    )


def note_in_history(warehouse: Warehouse, audit: DataFrame) -> dict[str, DataFrame]:
    """Append the run's history row; the whole history."""
    history = warehouse.append_once(
        audit, schemas.RUN_AUDIT.namespace, schemas.RUN_AUDIT.name, "invocation_id"
    )
    return {schemas.RUN_AUDIT.name: history}


def test(
    warehouse: Warehouse, relations: Mapping[str, DataFrame], declared: Sequence[Check]
) -> list[Row]:
    """Test everything once, before publishing: contracts, then the declared tests.

    A broken contract raises. Results are stored, and the failing rows of tests that have any.
    """
    contract = checks.all_contract_checks()
    tested = checks.results(relations, [*contract, *declared], warehouse.counted).collect()
    enforced = {check.name for check in contract}
    problems = [f"{r['check']}: {r['failures']}" for r in tested if r["check"] in enforced and r["failures"]]
    if problems:
        raise ContractViolation("; ".join(sorted(problems)))
    outcome = sorted((r for r in tested if r["check"] not in enforced), key=lambda r: r["check"])
    stored = warehouse.spark.createDataFrame(outcome, checks.RESULTS).coalesce(1)
    warehouse.write(stored, "dq_audit", "check_results")
    failing = {row["check"] for row in outcome if row["failures"]}
    for check in declared:
        if check.name in failing:
            warehouse.write(check.failing(relations), "dq_audit", check.name)
    return outcome


def report(
    warehouse: Warehouse, relations: Mapping[str, DataFrame], threshold_pct: float
) -> list[Row]:
    """Append the run's alerts to the alert log, and write them to the job log."""
    events = quality.alert_events(relations[schemas.COMPLETENESS.name], threshold_pct)
    alerts = quality.alerts(events, JOB, REPORT_TASK, warehouse.run_id)
    warehouse.append_once(alerts, "analytics", "dq_alerts", "run_id")
    raised = alerts.collect()  # at most one row per alert code
    for alert in raised:
        log.warning("quality alert: %s", json.dumps(alert.asDict()))
    return raised


def _together(
    warehouse: Warehouse,
    builders: Mapping[schemas.Relation, Callable[[], DataFrame]],
    declared: Sequence[Check] = (),
) -> dict[str, DataFrame]:
    """Write independent tables at the same time, so that one's last tasks leave no idle cores.

    Tests of single rows, declared and by contract, are counted on the rows as they pass.
    """

    def write(item: tuple[schemas.Relation, Callable[[], DataFrame]]) -> tuple[str, DataFrame]:
        relation, builder = item
        tests = checks.row_tests([*declared, *checks.all_contract_checks()], relation.name)
        return relation.name, warehouse.store(relation, builder(), tests)

    with ThreadPoolExecutor(CONCURRENT_TABLES) as pool:
        task = inheritable_thread_target(warehouse.spark)(write)
        return dict(pool.map(task, builders.items()))


def attach(spark: SparkSession, root: str, run_id: str | None = None) -> Warehouse:
    """Show in this session's catalog what was published under ``root`` last, or for ``run_id``."""
    warehouse = Warehouse.published(spark, root, run_id)
    warehouse.catalog.show(warehouse.snapshots.open(run_id=run_id), PUBLISHED, VIEWS)
    warehouse.show_logs(LOGS)
    return warehouse


def expire(spark: SparkSession, root: str, keep: int) -> tuple[list[int], list[str]]:
    """Remove the files that only snapshots before the last ``keep`` name; what went."""
    warehouse = Warehouse.published(spark, root)
    numbers, paths = warehouse.snapshots.expire(keep)
    shown = warehouse.catalog.current()
    if shown is not None and shown[1] == warehouse.root:
        warehouse.catalog.forget(numbers, PUBLISHED)
    return numbers, paths
