"""Quality metrics, history and alerts of a run."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftledger.functions.exact import percent
from siftledger.schemas import RUN_AUDIT

# Default alert threshold, alert codes, audited reason codes.
DEFAULT_QUARANTINE_ALERT_PCT = 40.0
RECONCILE_FAILED = "dq_reconcile_failed"
QUARANTINE_HIGH = "dq_quarantine_high"
AUDITED_REASONS = {
    "n_price_not_numeric": "price_not_numeric",
    "n_tax_not_numeric": "tax_not_numeric",
    "n_quantity_invalid": "quantity_missing_or_invalid",
    "n_date_unparseable": "date_unparseable",
    "n_transaction_id_invalid": "transaction_id_invalid",
}


def quarantine_reasons(quarantine: DataFrame) -> DataFrame:
    """One row per quarantined row and reason."""
    return quarantine.select(
        "transaction_id_raw", F.explode("dq_reasons").alias("dq_reason"), "_quarantined_at"
    )


def reason_counts(reasons: DataFrame) -> DataFrame:
    return reasons.groupBy("dq_reason").agg(F.count("*").alias("n"))


def completeness(raw: DataFrame, fact: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Rows received, modelled and quarantined, and whether they add up.

    Each number is counted from its own relation. One pass over the staged rows would
    be cheaper and prove nothing.
    """

    def rows(relation: DataFrame) -> Column:
        return relation.agg(F.count("*")).scalar()

    counts = raw.sparkSession.range(1).select(
        rows(raw).alias("rows_received"),
        rows(fact).alias("rows_modelled"),
        rows(quarantine).alias("rows_quarantined"),
    )
    accounted = F.col("rows_modelled") + F.col("rows_quarantined")
    return counts.select(
        "*",
        (accounted == F.col("rows_received")).alias("reconciles"),
        percent(F.col("rows_quarantined"), F.col("rows_received")).alias("quarantine_pct"),
    )


def run_audit(
    metrics: DataFrame, reasons: DataFrame, invocation_id: str, run_started_at: datetime | str
) -> DataFrame:
    """The history row of one run: completeness plus five reason counts."""
    counted = reasons.agg(
        F.struct(
            *[
                F.count_if(F.col("dq_reason") == code).alias(column)
                for column, code in AUDITED_REASONS.items()
            ]
        )
    )
    return metrics.select(
        F.lit(invocation_id).alias("invocation_id"),
        F.lit(run_started_at).cast("timestamp").alias("run_started_at"),
        "*",
        counted.scalar().alias("reason"),
    ).select(
        *[f"reason.{c}" if c in AUDITED_REASONS else c for c in RUN_AUDIT.schema.names]
    )


def not_yet_recorded(rows: DataFrame, history: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` the history does not hold."""
    return rows.join(history.select(key), key, "left_anti").select(*rows.columns)


def alert_events(
    metrics: DataFrame, threshold_pct: float = DEFAULT_QUARANTINE_ALERT_PCT
) -> DataFrame:
    """One row per raised alert code and metrics row; none when all is well."""
    accounted = F.col("rows_modelled") + F.col("rows_quarantined")
    events = F.array(
        F.when(accounted != F.col("rows_received"), RECONCILE_FAILED),
        F.when(F.col("quarantine_pct") > F.lit(str(threshold_pct)).cast("decimal(28,6)"), QUARANTINE_HIGH),
    )
    message = F.concat(
        F.lit("quarantine_pct="), F.col("quarantine_pct").cast("string"),
        F.lit(f" threshold={threshold_pct}"),
    )
    return metrics.select(F.explode(F.array_compact(events)).alias("event"), message.alias("message"))


def alerts(events: DataFrame, job: str, task: str, run_id: str) -> DataFrame:
    """Alert records with the ids a receiver needs."""
    return events.select(
        "event",
        F.lit(job).alias("job"),
        F.lit(task).alias("task"),
        F.lit(run_id).alias("run_id"),
        "message",
    )


def run_summary(metrics: DataFrame, reasons: DataFrame) -> DataFrame:
    """The report of a run: row counts, then reasons."""
    rows = metrics.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit("rows").alias("section"), F.lit(c).alias("item"), F.col(c).alias("n"))
                    for c in ("rows_received", "rows_modelled", "rows_quarantined")
                ]
            )
        ).alias("line")
    ).select("line.*")
    counts = reason_counts(reasons).select(F.lit("reason").alias("section"), F.col("dq_reason").alias("item"), "n")
    return rows.unionByName(counts).orderBy(F.desc("section"), F.desc("n"), "item")
