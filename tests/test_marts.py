"""Star schema and summaries of the edge feed, with totals worked out by hand."""

from __future__ import annotations

from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from siftledger.operators.spine import date_spine
from siftledger.plans import aggregates, marts, staging
from siftledger.schemas import (
    DIM_CUSTOMER,
    DIM_DATE,
    DIM_PRODUCT,
    FACT,
    MONTHLY_SALES,
    QUARANTINE,
    SALES_BY_CUSTOMER,
    SALES_BY_PRODUCT,
)
from siftledger.plans.checks import schema_problems
from siftledger.session import materialise
from siftledger.sources.delimited import read_source

RUN_TS = datetime(2024, 1, 2, 3, 4, 5, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def staged(spark, edge_path):
    return materialise(staging.staged(read_source(spark, edge_path, RUN_TS)), "test-staged")


@pytest.fixture(scope="module")
def valid(staged):
    return marts.valid_transactions(staged)


@pytest.fixture(scope="module")
def fact(valid):
    return marts.fct_transactions(valid)


def test_fact(fact):
    assert schema_problems(fact, FACT) == []
    rows = {r.transaction_id: r for r in fact.collect()}
    assert rows[3].customer_id == -1 and rows[3].missing_customer
    assert rows[2].date_key == 20240105
    sums = fact.agg(*[F.sum(c) for c in ("quantity", "subtotal", "tax_amount", "total_amount")]).first()
    assert tuple(sums) == (13, Decimal("36.15"), Decimal("1.85"), Decimal("38.00"))


def test_dimensions(spark, valid):
    products = marts.dim_product(valid)
    customers = marts.dim_customer(valid)
    assert {tuple(r) for r in products.collect()} == {(7, "Widget"), (8, "Gadget"), (9, 'Nut, "hex"')}
    assert {tuple(r) for r in customers.collect()} == {
        (10, False), (11, False), (12, False), (-1, True),
    }
    assert schema_problems(products, DIM_PRODUCT) == []
    assert schema_problems(customers, DIM_CUSTOMER) == []


def test_unknown_customer_exists_even_without_a_valid_row(valid):
    assert [tuple(r) for r in marts.dim_customer(valid.where("false")).collect()] == [(-1, True)]


def test_calendar(spark):
    calendar = marts.dim_date(spark)
    assert schema_problems(calendar, DIM_DATE) == []
    assert calendar.count() == 4018
    last = calendar.orderBy(F.desc("date_key")).first()
    assert last.date_day == date(2030, 12, 31)
    row = calendar.where("date_key = 20230716").first()
    assert tuple(row) == (20230716, date(2023, 7, 16), 2023, 7, 16, "Jul", 7)


def test_spine_bounds_may_be_columns(spark, fact):
    first = fact.agg(F.min("transaction_date")).scalar()
    after = fact.agg(F.date_add(F.max("transaction_date"), 1)).scalar()
    days = date_spine(spark, first, after)
    assert days.count() == (date(2024, 2, 29) - date(2024, 1, 5)).days + 1


def test_quarantine_is_verbatim(staged):
    rows = marts.quarantine(staged, RUN_TS)
    assert schema_problems(rows, QUARANTINE) == []
    by_id = {r.transaction_id_raw: r for r in rows.collect()}
    assert len(by_id) == 13
    assert (by_id["5"].price_raw, by_id["5"].tax_raw, by_id["5"].quantity_raw) == ("Ten", "Five", None)
    assert rows.select("_quarantined_at").distinct().count() == 1


def test_monthly_sales(fact):
    months = aggregates.monthly_sales(fact)
    assert schema_problems(months, MONTHLY_SALES) == []
    rows = {r.month: r for r in months.collect()}
    january, february = rows[date(2024, 1, 1)], rows[date(2024, 2, 1)]
    assert (january.num_transactions, january.total_amount) == (4, Decimal("28.90"))
    assert (january.num_customers, january.distinct_products) == (3, 3)
    assert january.avg_transaction_value == Decimal("7.23")  # 7.225
    assert january.avg_units_per_transaction == Decimal("2.25")
    assert (february.num_customers, february.total_amount) == (0, Decimal("9.10"))


def test_sales_by_customer(fact):
    sales = aggregates.sales_by_customer(fact)
    assert schema_problems(sales, SALES_BY_CUSTOMER) == []
    rows = {r.customer_id: r for r in sales.collect()}
    assert set(rows) == {10, 11, 12, -1}
    unknown = rows[-1]
    assert unknown.is_unknown and not rows[10].is_unknown
    assert (unknown.num_transactions, unknown.distinct_products) == (2, 2)
    assert unknown.avg_transaction_value == Decimal("4.63")  # 9.25 / 2
    assert unknown.first_transaction_date == date(2024, 1, 6)
    assert unknown.last_transaction_date == date(2024, 2, 29)


def test_sales_by_product(fact, valid):
    sales = aggregates.sales_by_product(fact, marts.dim_product(valid))
    assert schema_problems(sales, SALES_BY_PRODUCT) == []
    rows = {r.product_id: r for r in sales.collect()}
    assert {k: r.revenue_share_pct for k, r in rows.items()} == {
        7: Decimal("66.4"), 8: Decimal("33.2"), 9: Decimal("0.4"),
    }
    assert rows[7].avg_unit_price == Decimal("6.75")


def test_two_names_of_a_product_fan_out(spark, fact):
    names = spark.createDataFrame(
        [(7, "Widget"), (7, "Gizmo"), (8, "Gadget")], "product_id long, product_name string"
    )
    rows = aggregates.sales_by_product(fact, names).collect()
    widgets = [r for r in rows if r.product_id == 7]
    assert len(widgets) == 2 and widgets[0].total_amount == widgets[1].total_amount == Decimal("25.25")
    assert {r.product_id for r in rows} == {7, 8}  # 9 has no partner
    assert sum(r.revenue_share_pct for r in rows) == Decimal("100.0")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(fact, valid, staged):
    """What the summaries may not do at scale: sort whole tables, or gather rows in one window."""
    product = plan_of(aggregates.sales_by_product(fact, marts.dim_product(valid)))
    assert "Window" not in product and "CartesianProduct" not in product
    assert "NestedLoop" not in product
    for summary in (aggregates.monthly_sales(fact), aggregates.sales_by_customer(fact)):
        plan = plan_of(summary)
        assert "partial_sum" in plan and "Sort" not in plan
    assert "PushedFilters: [IsNotNull(is_valid), EqualTo(is_valid,true)]" in plan_of(fact)
    read = plan_of(marts.dim_product(valid))
    assert "ReadSchema: struct<product_id:bigint,product_name:string,is_valid:boolean>" in read
