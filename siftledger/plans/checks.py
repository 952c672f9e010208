"""Declarative data tests.

A check yields its failing rows, and a status from their number. Checks that look at
one row at a time are counted together, one scan per relation; uniqueness and
references reduce the data to distinct keys before any join, so a hot key is one row.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftledger.schemas import (
    COMPLETENESS,
    CONTRACTS,
    DIM_CUSTOMER,
    DIM_DATE,
    DIM_PRODUCT,
    FACT,
    MONEY,
    QUARANTINE,
    RANGE_CODES,
    REASON_CODES,
    RUN_AUDIT,
    STAGED,
    Relation,
)

Relations = Mapping[str, DataFrame]

REASONS = "dq_quarantine_reasons"


@dataclass(frozen=True)
class Severity:
    """``warn`` above one number of failures, ``fail`` from another; None is never."""

    warn_above: int | None = None
    fail_from: int | None = 1

    def status(self) -> str:
        """SQL for the status that follows from the column ``failures``."""
        cases = ""
        if self.fail_from is not None:
            cases += f" WHEN failures >= {self.fail_from} THEN 'fail'"
        if self.warn_above is not None:
            cases += f" WHEN failures > {self.warn_above} THEN 'warn'"
        return f"CASE{cases} ELSE 'pass' END" if cases else "'pass'"

    @property
    def label(self) -> str:
        return "error" if self.warn_above is None else "warn"


ERROR = Severity()


@dataclass(frozen=True)
class Check:
    """A named test on one relation."""

    name: str
    relation: str
    severity: Severity = ERROR

    def failing(self, relations: Relations) -> DataFrame:
        raise NotImplementedError

    def failures(self, relations: Relations) -> DataFrame:
        """One row, one column ``failures``."""
        return self.failing(relations).selectExpr("count(*) AS failures")


@dataclass(frozen=True)
class RowCheck(Check):
    """Rows for which the SQL condition ``broken`` is true fail.

    ``kept`` names the columns that failing rows are stored with; none means all.
    """

    broken: str = "false"
    kept: tuple[str, ...] = ("*",)

    def failing(self, relations: Relations) -> DataFrame:
        return relations[self.relation].where(self.broken).select(*self.kept)


@dataclass(frozen=True)
class UniqueCheck(Check):
    """Each non-NULL value of ``column`` held more than once fails."""

    column: str = ""

    def failing(self, relations: Relations) -> DataFrame:
        column = F.col(self.column)
        return (
            relations[self.relation]
            .where(column.isNotNull())
            .groupBy(column.alias("unique_field"))
            .agg(F.count("*").alias("n_records"))
            .where("n_records > 1")
        )


@dataclass(frozen=True)
class ReferenceCheck(Check):
    """Each row whose ``column`` has no partner in ``to.key`` fails.

    Failing rows are given as key and number of rows; no row is left out of the count.
    """

    column: str = ""
    to: str = ""
    key: str = ""

    def failing(self, relations: Relations) -> DataFrame:
        column = F.col(self.column)
        used = (
            relations[self.relation]
            .where(column.isNotNull())
            .groupBy(column.alias("from_field"))
            .agg(F.count("*").alias("n_records"))
        )
        known = relations[self.to].select(F.col(self.key).alias("from_field"))
        return used.join(known, "from_field", "left_anti")

    def failures(self, relations: Relations) -> DataFrame:
        return self.failing(relations).selectExpr("coalesce(sum(n_records), 0) AS failures")


@dataclass(frozen=True)
class AcceptedValuesCheck(Check):
    """Each distinct value of ``column`` outside ``values`` fails; NULL passes."""

    column: str = ""
    values: tuple = ()

    def failing(self, relations: Relations) -> DataFrame:
        column = F.col(self.column)
        return (
            relations[self.relation]
            .where(~column.isin(*self.values))
            .groupBy(column.alias("value_field"))
            .agg(F.count("*").alias("n_records"))
        )


@dataclass(frozen=True)
class NotNullProportionCheck(Check):
    """Fails with one row when less than ``at_least`` of ``column`` is present."""

    column: str = ""
    at_least: float = 1.0

    def failing(self, relations: Relations) -> DataFrame:
        present = F.col(self.column).isNotNull().cast("int")
        return (
            relations[self.relation]
            .agg(F.avg(present).alias("not_null_proportion"))
            .where(F.col("not_null_proportion") < self.at_least)
        )


def not_null(relation: str, *columns: str) -> list[Check]:
    return [RowCheck(f"not_null_{relation}_{c}", relation, broken=f"{c} IS NULL") for c in columns]


def unique(relation: str, column: str) -> Check:
    return UniqueCheck(f"unique_{relation}_{column}", relation, column=column)


def references(relation: str, column: str, to: str) -> Check:
    return ReferenceCheck(
        f"relationships_{relation}_{column}", relation, column=column, to=to, key=column
    )


def declared_checks(quarantine_severity: Severity = Severity(warn_above=0, fail_from=50)) -> list[Check]:
    """The tests declared on the warehouse.

    The default severity of quarantined rows warns on any and fails from 50; give
    thresholds that suit the size of the feed.
    """
    fact = FACT.name
    return [
        *not_null(DIM_PRODUCT.name, "product_id", "product_name"),
        *not_null(DIM_CUSTOMER.name, "customer_id"),
        *not_null(DIM_DATE.name, "date_key"),
        *not_null(
            fact,
            "transaction_id",
            "customer_id",
            "product_id",
            "date_key",
            "quantity",
            "unit_price",
            "tax_amount",
            "total_amount",
        ),
        *not_null(RUN_AUDIT.name, "invocation_id"),
        unique(DIM_PRODUCT.name, "product_id"),
        unique(DIM_CUSTOMER.name, "customer_id"),
        unique(DIM_DATE.name, "date_key"),
        unique(fact, "transaction_id"),
        references(fact, "customer_id", DIM_CUSTOMER.name),
        references(fact, "product_id", DIM_PRODUCT.name),
        references(fact, "date_key", DIM_DATE.name),
        AcceptedValuesCheck(
            "accepted_values_dq_completeness_reconciles",
            COMPLETENESS.name,
            column="reconciles",
            values=(True,),
        ),
        RowCheck("range_fct_transactions_quantity", fact, broken="quantity < 1"),
        NotNullProportionCheck(
            "not_null_proportion_stg_dq_reasons", STAGED.name, column="dq_reasons", at_least=0.0
        ),
        vocabulary_check(REASON_CODES + RANGE_CODES),
        RowCheck("partitions_reconcile", COMPLETENESS.name, broken="NOT reconciles"),
        RowCheck(
            "quarantine_within_threshold",
            QUARANTINE.name,
            quarantine_severity,
            broken="true",
            kept=("transaction_id_raw", "dq_reasons"),
        ),
        RowCheck(
            "total_amount_formula",
            fact,
            broken="total_amount <> quantity * unit_price + tax_amount",
            kept=("transaction_id", "total_amount", "quantity", "unit_price", "tax_amount"),
        ),
    ]


def vocabulary_check(codes: Sequence[str]) -> Check:
    """Reasons outside ``codes`` fail."""
    known = ", ".join(f"'{code}'" for code in codes)
    return RowCheck(
        "dq_reasons_known",
        REASONS,
        broken=f"dq_reason NOT IN ({known})",
        kept=("transaction_id_raw", "dq_reason"),
    )


def digits_lost_checks(relation: str = STAGED.name) -> list[Check]:
    """Numbers with more digits than the money type keeps (warnings).

    ``digits_lost_``: longer fractions, which were rounded. ``overflow_``: numbers in the
    accepted form that are too large, which have no typed value.
    """
    longer = rf"RLIKE '^[0-9]+\\.[0-9]{{{MONEY.scale}}}[0-9]*[1-9]'"
    number = r"RLIKE '^[0-9]+(\\.[0-9]+)?\\z'"
    warning = Severity(warn_above=0, fail_from=None)
    return [
        RowCheck(f"{name}_{typed}", relation, warning, broken=f"{typed} IS {state} AND {text} {form}")
        for typed, text in (("unit_price", "price_raw"), ("tax_amount", "tax_raw"))
        for name, state, form in (
            ("digits_lost", "NOT NULL", longer),
            ("overflow", "NULL", number),
        )
    ]


def contract_checks(relation: Relation) -> list[Check]:
    """The constraints a relation enforces: required columns and the primary key."""
    checks = [
        RowCheck(f"contract_{relation.name}_{c}_required", relation.name, broken=f"{c} IS NULL")
        for c in relation.required
    ]
    if relation.primary_key:
        checks.append(
            UniqueCheck(
                f"contract_{relation.name}_primary_key", relation.name, column=relation.primary_key
            )
        )
    return checks


def all_contract_checks(contracts: Iterable[Relation] = CONTRACTS) -> list[Check]:
    return [check for relation in contracts for check in contract_checks(relation)]


def schema_problems(df: DataFrame, relation: Relation) -> list[str]:
    """Differences between a frame's columns and the declared ones, in words."""
    declared = {f.name: f.dataType.simpleString() for f in relation.schema}
    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    return [
        f"{relation.name}.{name}: declared {declared.get(name, 'nothing')}, found {actual.get(name, 'nothing')}"
        for name in [*declared, *(n for n in actual if n not in declared)]
        if declared.get(name) != actual.get(name)
    ]


RESULTS = "check string, severity string, failures long, status string"


def row_tests(checks: Iterable[Check], relation: str) -> dict[str, Column]:
    """Counts of failing rows, by name, of the tests on single rows of ``relation``."""
    return {
        c.name: F.expr(f"count_if({c.broken})")
        for c in checks
        if isinstance(c, RowCheck) and c.relation == relation
    }


def results(
    relations: Relations, checks: Sequence[Check], counted: Mapping[str, int] | None = None
) -> DataFrame:
    """``check``, ``severity``, ``failures`` and ``status``, one row per check.

    ``counted``: failures that are known already, by name. Keys tested under two names are
    counted once.
    """
    known = {c.name: counted[c.name] for c in checks if counted and c.name in counted}
    by_relation: dict[str, list[RowCheck]] = {}
    by_key: dict[tuple[str, str], list[str]] = {}
    for check in checks:
        if isinstance(check, UniqueCheck):
            by_key.setdefault((check.relation, check.column), []).append(check.name)
        elif isinstance(check, RowCheck) and check.name not in known:
            by_relation.setdefault(check.relation, []).append(check)
    found = [_count_rows(relations[name], group) for name, group in by_relation.items()]
    for (relation, column), names in by_key.items():
        failures = UniqueCheck(names[0], relation, column=column).failures(relations)
        lines = ", ".join(f"'{name}', failures" for name in names)
        found.append(failures.selectExpr(f"stack({len(names)}, {lines}) AS (check, failures)"))
    found += [
        check.failures(relations).selectExpr(f"'{check.name}' AS check", "failures")
        for check in checks
        if not isinstance(check, (RowCheck, UniqueCheck))
    ]
    if known:
        spark = next(iter(relations.values())).sparkSession
        found.append(spark.createDataFrame(list(known.items()), "check string, failures long"))
    status = " ".join(f"WHEN '{c.name}' THEN {c.severity.status()}" for c in checks)
    label = " ".join(f"WHEN '{c.name}' THEN '{c.severity.label}'" for c in checks)
    return reduce(DataFrame.union, found).selectExpr(
        "check", f"CASE check {label} END AS severity", "failures", f"CASE check {status} END AS status"
    )


def _count_rows(df: DataFrame, checks: Sequence[RowCheck]) -> DataFrame:
    """``check`` and ``failures`` of tests on single rows, in one scan."""
    counts = df.selectExpr(*[f"count_if({c.broken}) AS `{c.name}`" for c in checks])
    lines = ", ".join(f"'{c.name}', `{c.name}`" for c in checks)
    return counts.selectExpr(f"stack({len(checks)}, {lines}) AS (check, failures)")


def freshness(
    raw: DataFrame, now: datetime | str, warn_hours: int = 24, fail_hours: int = 72
) -> DataFrame:
    """Age of the newest load: pass, warn or fail; a table without rows fails."""
    newest = F.max("_ingested_at")
    age = F.lit(now).cast("timestamp").cast("double") - F.col("newest").cast("double")
    late = F.when(F.col("newest").isNull() | (age > fail_hours * 3600), "fail").when(
        age > warn_hours * 3600, "warn"
    )
    status = F.coalesce(late, F.lit("pass"))
    return raw.agg(newest.alias("newest")).select(
        F.lit("freshness_raw").alias("check"),
        F.lit("error").alias("severity"),
        (status != "pass").cast("long").alias("failures"),
        status.alias("status"),
    )
