"""Every data test, failing and passing, and the statuses that follow."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from siftledger.plans import checks
from siftledger.plans.checks import (
    AcceptedValuesCheck,
    Check,
    NotNullProportionCheck,
    ReferenceCheck,
    RowCheck,
    Severity,
    UniqueCheck,
)
from siftledger.schemas import CONTRACTS, DIM_CUSTOMER, DIM_PRODUCT, FACT, MONEY, REASON_CODES


@pytest.fixture(scope="module")
def relations(spark):
    return {
        "sales": spark.createDataFrame(
            [(1, 10, 2, True), (1, 10, 0, True), (2, 99, 5, False), (3, None, None, None), (None, 99, 1, True)],
            "id long, customer long, quantity int, good boolean",
        ),
        "people": spark.createDataFrame([(10,), (20,)], "customer long"),
        "none": spark.createDataFrame([], "id long, dq_reason string"),
    }


def result(relations, *declared):
    return {r.check: (r.failures, r.status) for r in checks.results(relations, list(declared)).collect()}


def test_row_checks(relations):
    found = result(
        relations,
        *checks.not_null("sales", "id", "customer"),
        RowCheck("range", "sales", broken="quantity < 1"),
        RowCheck("fine", "sales", broken="quantity < 0"),
        RowCheck("empty", "none", broken="id IS NULL"),
    )
    assert found == {
        "not_null_sales_id": (1, "fail"),
        "not_null_sales_customer": (1, "fail"),
        "range": (1, "fail"),  # a missing quantity is not out of range
        "fine": (0, "pass"),
        "empty": (0, "pass"),
    }


def test_unique_ignores_null_and_counts_values(relations):
    check = UniqueCheck("u", "sales", column="id")
    assert [tuple(r) for r in check.failing(relations).collect()] == [(1, 2)]
    assert result(relations, check) == {"u": (1, "fail")}
    assert result(relations, UniqueCheck("p", "people", column="customer")) == {"p": (0, "pass")}


def test_reference_counts_rows_of_each_orphan(relations):
    check = ReferenceCheck("r", "sales", column="customer", to="people", key="customer")
    assert [tuple(r) for r in check.failing(relations).collect()] == [(99, 2)]
    assert result(relations, check) == {"r": (2, "fail")}


def test_reference_joins_distinct_keys_only(relations):
    check = ReferenceCheck("r", "sales", column="customer", to="people", key="customer")
    plan = check.failing(relations)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("LeftAnti") < plan.index("partial_count")


def test_accepted_values(relations):
    check = AcceptedValuesCheck("a", "sales", column="good", values=(True,))
    assert [tuple(r) for r in check.failing(relations).collect()] == [(False, 1)]
    assert result(relations, check) == {"a": (1, "fail")}


@pytest.mark.parametrize(("at_least", "status"), [(0.0, "pass"), (0.8, "pass"), (0.81, "fail")])
def test_not_null_proportion(relations, at_least, status):
    check = NotNullProportionCheck("n", "sales", column="id", at_least=at_least)
    assert result(relations, check)["n"][1] == status


def test_not_null_proportion_of_nothing_passes(relations):
    check = NotNullProportionCheck("n", "none", column="id", at_least=0.5)
    assert result(relations, check) == {"n": (0, "pass")}


@pytest.mark.parametrize(
    ("failures", "status"), [(0, "pass"), (1, "warn"), (49, "warn"), (50, "fail")]
)
def test_threshold_severity(spark, failures, status):
    severity = Severity(warn_above=0, fail_from=50)
    relations = {"q": spark.range(failures).toDF("id")}
    row = checks.results(relations, [RowCheck("t", "q", severity, broken="true")]).first()
    assert (row.failures, row.status, row.severity) == (failures, status, "warn")


def test_warning_only_severity(spark):
    severity = Severity(warn_above=0, fail_from=None)
    rows = spark.range(1000).toDF("id")
    assert checks.results({"q": rows}, [RowCheck("t", "q", severity, broken="true")]).first().status == "warn"


def test_vocabulary(spark):
    rows = spark.createDataFrame([("1", REASON_CODES[0]), ("2", "made_up")], "transaction_id_raw string, dq_reason string")
    check = checks.vocabulary_check(REASON_CODES)
    assert [tuple(r) for r in check.failing({checks.REASONS: rows}).collect()] == [("2", "made_up")]


def test_digits_lost(spark):
    rows = spark.createDataFrame(
        [("1.1234567", "1"), ("1.1234560", "0.0000001"), ("1.1", "x.0000001"), ("12", None),
         ("1234567890123456789", "9" * 18)],
        "price_raw string, tax_raw string",
    ).select("*", F.col("price_raw").try_cast(MONEY).alias("unit_price"),
             F.col("tax_raw").try_cast(MONEY).alias("tax_amount"))
    found = result({"stg_customer_transactions": rows}, *checks.digits_lost_checks())
    assert found == {
        "digits_lost_unit_price": (1, "warn"), "digits_lost_tax_amount": (1, "warn"),
        "overflow_unit_price": (1, "warn"), "overflow_tax_amount": (0, "pass"),
    }


def test_schema_problems(spark):
    good = spark.createDataFrame([], DIM_PRODUCT.schema)
    assert checks.schema_problems(good, DIM_PRODUCT) == []
    assert checks.schema_problems(good.drop("product_name"), DIM_PRODUCT) == [
        "dim_product.product_name: declared string, found nothing"
    ]
    wrong = good.withColumn("product_id", F.col("product_id").cast("int")).withColumn("extra", F.lit(1))
    assert len(checks.schema_problems(wrong, DIM_PRODUCT)) == 2


def test_contract_constraints(spark):
    rows = spark.createDataFrame([(1, True), (1, False), (None, None)], "customer_id long, is_unknown boolean")
    found = result({DIM_CUSTOMER.name: rows}, *checks.contract_checks(DIM_CUSTOMER))
    assert {name: n for name, (n, _) in found.items()} == {
        "contract_dim_customer_customer_id_required": 1,
        "contract_dim_customer_is_unknown_required": 1,
        "contract_dim_customer_primary_key": 1,
    }


def test_declared_tests():
    declared = checks.declared_checks()
    kinds = [sum(c.name.startswith(p) for c in declared) for p in ("not_null_", "unique_", "relationships_")]
    assert len(declared) == 27 and kinds == [14, 4, 3]  # one of the 14 is the proportion
    assert len({c.name for c in declared}) == 27
    assert all(isinstance(c, Check) for c in declared)
    assert FACT in CONTRACTS and len(FACT.required) == 11


@pytest.mark.parametrize(
    ("now", "status"),
    [("2024-01-02 00:00:00", "pass"), ("2024-01-03 00:00:00", "pass"), ("2024-01-03 00:00:01", "warn"),
     ("2024-01-05 00:00:00", "warn"), ("2024-01-05 00:00:01", "fail")],
)
def test_freshness(spark, now, status):
    raw = spark.createDataFrame([(datetime(2024, 1, 1),), (datetime(2024, 1, 2),)], "_ingested_at timestamp")
    row = checks.freshness(raw, now).first()
    assert (row.status, row.failures) == (status, int(status != "pass"))


def test_freshness_of_nothing_fails(spark):
    raw = spark.createDataFrame([], "_ingested_at timestamp")
    assert checks.freshness(raw, "2024-01-02 00:00:00").first().status == "fail"
