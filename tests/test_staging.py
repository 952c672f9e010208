"""Classification of the edge feed and of single dirty values."""

from __future__ import annotations

import random
from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from siftledger.operators.classify import DEFAULT_RULES, Rule
from siftledger.plans import marts, staging
from siftledger.schemas import RANGE_CODES, REASON_CODES, STAGED
from siftledger.sources.delimited import read_source

RUN_TS = datetime(2024, 1, 2, 3, 4, 5, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def staged(spark, edge_path):
    return staging.staged(read_source(spark, edge_path, RUN_TS)).cache()


EXPECTED = {
    "4": ["price_not_numeric"],
    "5": ["price_not_numeric", "tax_not_numeric", "quantity_missing_or_invalid"],
    "6": ["date_unparseable"],
    "7": ["date_unparseable"],
    "X8": ["transaction_id_invalid"],
    None: ["transaction_id_invalid"],
    "99999999999999999999": ["transaction_id_invalid"],
    "TT16": ["transaction_id_invalid"],
    "9": ["quantity_non_positive"],
    "11": ["price_non_positive"],
    "12": ["tax_not_numeric"],
    "13": ["duplicate_transaction_id"],
    "T13": ["duplicate_transaction_id"],
}


def test_reasons_of_the_edge_feed(staged):
    rows = staged.collect()
    assert len(rows) == 18
    found = {r.transaction_id_raw: r.dq_reasons for r in rows if r.dq_reasons}
    assert found == EXPECTED
    assert all(r.is_valid == (not r.dq_reasons) for r in rows)


def test_typed_values_of_valid_rows(staged):
    rows = {r.transaction_id: r for r in staged.where("is_valid").collect()}
    assert sorted(rows) == [1, 2, 3, 10, 15]
    assert rows[2].transaction_date == date(2024, 1, 5)
    assert (rows[2].product_id, rows[2].product_name) == (7, "Widget")
    totals = {k: r.total_amount for k, r in rows.items()}
    assert totals == {
        1: Decimal("22.25"), 2: Decimal("3"), 3: Decimal("9.10"), 10: Decimal("3.50"), 15: Decimal("0.15"),
    }
    assert rows[10].quantity == 3
    assert rows[15].product_name == 'Nut, "hex"' and rows[15].missing_customer
    assert rows[3].missing_customer and not rows[1].missing_customer


def test_columns_and_lineage(staged):
    assert staged.columns == STAGED.schema.names
    assert [f.dataType for f in staged.schema] == [f.dataType for f in STAGED.schema]
    assert {r._source_file for r in staged.select("_source_file").collect()} == {"edge.csv"}
    assert staged.where(F.col("_ingested_at") != F.lit(RUN_TS)).count() == 0


def test_rule_codes_are_the_vocabulary():
    assert tuple(rule.code for rule in DEFAULT_RULES) == REASON_CODES + RANGE_CODES


def test_no_number_gets_a_wrong_code(feed):
    """Too large, rounded to nothing, and just inside; zero stays zero, words stay words."""
    cases = {
        "9" * 18: [],
        "9" * 19: ["price_out_of_range"],
        "000" + "9" * 18: [],
        "1" + "0" * 18 + ".5": ["price_out_of_range"],
        "0.000001": [],
        "0.0000004": ["price_out_of_range"],
        "0.000": ["price_non_positive"],
        "0": ["price_non_positive"],
        "9e9": ["price_not_numeric"],
    }
    rows = staging.staged(feed(*[{"price": text} for text in cases])).collect()
    assert {r.price_raw: r.dq_reasons for r in rows} == cases
    taxes = {"9" * 19: ["tax_out_of_range"], "0.0000004": [], "0": [], "": ["tax_not_numeric"]}
    rows = staging.staged(feed(*[{"tax": text} for text in taxes])).collect()
    assert {r.tax_raw: r.dq_reasons for r in rows} == taxes


def test_a_rule_can_be_added(feed):
    rules = (*DEFAULT_RULES, Rule("price_implausible", "unit_price > 1000"))
    rows = staging.staged(feed({"price": "5000"}, {}), rules=rules).orderBy("transaction_id").collect()
    assert [r.dq_reasons for r in rows] == [["price_implausible"], []]


def test_missing_product_has_no_reason_but_is_not_hidden(feed):
    row = staging.staged(feed({"product_id": None, "product_name": "  "})).first()
    assert row.is_valid and row.product_id is None and row.product_name is None


def test_negative_tax_is_not_numeric(feed):
    row = staging.staged(feed({"tax": "-0.5"})).first()
    assert row.dq_reasons == ["tax_not_numeric"] and row.total_amount is None
    assert row.subtotal == Decimal("21")


def test_the_feed_may_be_one_row_many_times(feed):
    """Copies with an unreadable id are not duplicates of each other; copies with one are."""
    rows = staging.staged(feed(*[{"transaction_id": "?"}] * 20, *[{"transaction_id": "5"}] * 10))
    reasons = [tuple(r.dq_reasons) for r in rows.collect()]
    assert reasons.count(("transaction_id_invalid",)) == 20
    assert reasons.count(("duplicate_transaction_id",)) == 10


def test_random_rows_keep_the_invariants(feed):
    pick = random.Random(5)
    values = {
        "transaction_id": ["1", "T1", "2", "X", None, "", "77", "T88", "9" * 25],
        "customer_id": ["5.0", "6", None, "", "x"],
        "transaction_date": ["2024-01-05", "05-01-2024", "2024-13-01", "soon", None],
        "quantity": ["1.0", "0", "0.4", None, "many", "2.5"],
        "price": ["1.00", "0", "free", None, "-1"],
        "tax": ["0", "0.10", "none", None],
    }
    rows = feed(*[{c: pick.choice(v) for c, v in values.items()} for _ in range(400)])
    staged = staging.staged(rows).cache()
    fact = marts.fct_transactions(marts.valid_transactions(staged))
    quarantined = marts.quarantine(staged, RUN_TS)
    assert fact.count() + quarantined.count() == 400
    assert staged.where("is_valid <> (size(dq_reasons) = 0)").count() == 0
    assert fact.where("total_amount <> quantity * unit_price + tax_amount").count() == 0
    assert fact.groupBy("transaction_id").count().where("count > 1").count() == 0


@pytest.mark.parametrize("limit", [1_000_000, 2])
def test_rows_that_are_stored_get_the_same_verdicts(feed, limit):
    """Typed after they are marked, by place if the repeated ids are many."""
    from siftledger.session import materialise

    ids = ["1", "T1", "2", "X", None, "", "77", "T88", "9" * 25, *map(str, range(20, 40)), *map(str, range(25, 45))]
    raw = materialise(feed(*[{"transaction_id": i, "price": str(n % 3)} for n, i in enumerate(ids)]), "test-raw")
    expected = staging.staged(raw)
    found = staging.staged(raw, max_broadcast_keys=limit, min_hot_rows=3, stored=True)
    assert found.schema == expected.schema
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
    assert expected.where("is_duplicate_id").count() == 32
