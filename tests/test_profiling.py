"""The profile of a dirty feed, against answers counted in Python."""

from __future__ import annotations

import random
import re
from collections import Counter
from datetime import date
from decimal import Decimal

import pytest

from siftledger.plans import profiling

NUMBER = re.compile(r"[0-9]+(\.[0-9]+)?")


@pytest.fixture(scope="module")
def raw(feed):
    pick = random.Random(13)
    values = {
        "transaction_id": ["1", "T1", "TT2", "X", None, "", "77", "T88"],
        "customer_id": ["5.0", "6", None, "", " ", "x", "5.00"],
        "transaction_date": ["2024-01-05", "05-01-2023", "2024-13-01", "soon", None, ""],
        "product_id": ["P7", "7", None, "PP7", "x"],
        "product_name": ["Widget", " ", None, "Gadget"],
        "quantity": ["1.0", "0", "0.00", "0.00001", "3", None, "many", "2.5", " "],
        "price": ["10.00", "0", "free", None, "-1", "8"],
        "tax": ["0", "0.50", "none", None, "2", "3.000"],
    }
    return feed(*[{c: pick.choice(v) for c, v in values.items()} for _ in range(300)]).cache()


@pytest.fixture(scope="module")
def rows(raw):
    return raw.collect()


@pytest.fixture(scope="module")
def report(raw):
    return profiling.profile(raw)


def number(text):
    return Decimal(text) if text is not None and NUMBER.fullmatch(text) else None


def blank(text):
    return text is None or text.strip(" ") == ""


def test_report_answers_every_question(report):
    assert len(report) == len(profiling.ONE_SCAN) + 10


def test_one_scan_agrees_with_single_questions(raw, report):
    for question in profiling.ONE_SCAN:
        assert report[question].collect() == profiling.ask(raw, question).collect()


def test_missing(rows, report):
    assert report["total_rows"].first().total_rows == 300
    found = report["missing"].first()
    assert found.tx_id_missing == sum(blank(r.transaction_id) for r in rows)
    assert found.customer_id_missing == sum(blank(r.customer_id) for r in rows)
    assert found.quantity_missing == sum(blank(r.quantity) for r in rows)


def test_ids(rows, report):
    bare = [r.transaction_id.removeprefix("T") for r in rows if r.transaction_id is not None]
    found = report["transaction_ids"].first()
    assert found.numeric_after_strip == sum(bool(re.fullmatch("[0-9]+", b)) for b in bare)
    assert (found.distinct_after_strip, found.total) == (len(set(bare)), 300)
    groups = Counter(r.transaction_id and r.transaction_id.removeprefix("T") for r in rows)
    duplicates = [tuple(r) for r in report["duplicate_ids"].collect()]
    assert dict(duplicates) == {k: n for k, n in groups.items() if n > 1}
    assert [n for _, n in duplicates] == sorted((n for _, n in duplicates), reverse=True)
    customers = report["customer_ids"].first()
    assert customers.float_form == sum(r.customer_id in ("5.0", "5.00") for r in rows)
    assert customers.distinct_vals == len({r.customer_id for r in rows} - {None})
    products = report["product_ids"].first()
    assert products.p_prefixed == sum((r.product_id or "").startswith("P") for r in rows)
    assert sum(r.n for r in report["product_names"].collect()) == 300


def test_dates(rows, report):
    found = report["date_formats"].first()
    dates = [r.transaction_date for r in rows]
    assert found.iso_ymd == dates.count("2024-01-05") + dates.count("2024-13-01")
    assert found.dmy == dates.count("05-01-2023")
    assert found.other == dates.count("soon") + dates.count("")  # a missing date is in no group
    assert tuple(report["date_range"].first()) == (date(2023, 1, 5), date(2024, 1, 5))


def test_numbers(rows, report):
    quantity = report["quantity"].first()
    assert quantity.numeric_vals == sum(number(r.quantity) is not None for r in rows)
    assert quantity.zero_or_negative == sum(number(r.quantity) == 0 for r in rows)
    prices = report["price"].first()
    bad = [r.price for r in rows if r.price is not None and number(r.price) is None]
    assert prices.non_numeric_vals == len(bad)
    assert dict(map(tuple, report["bad_prices"].collect())) == Counter(bad)
    assert dict(map(tuple, report["bad_taxes"].collect())) == Counter(
        r.tax for r in rows if r.tax == "none"
    )


def test_tax_summary(rows, report):
    taxes = [number(r.tax) for r in rows if number(r.tax) is not None]
    found = report["tax_summary"].first()
    assert (found.n, found.min, found.max) == (len(taxes), 0, 3)
    mean = sum(taxes) / len(taxes)
    assert found.avg == round(mean, 2)
    spread = (sum((t - mean) ** 2 for t in taxes) / (len(taxes) - 1)).sqrt()
    assert found.stddev == round(spread, 2)
    assert found.whole_numbers == sum(t == int(t) for t in taxes)
    both = [(number(r.tax), number(r.price)) for r in rows]
    both = [(t, p) for t, p in both if t is not None and p is not None]
    ranges = report["tax_vs_price"].first()
    assert (ranges.min_price, ranges.max_price) == (min(p for _, p in both), max(p for _, p in both))
    shares = [t / p for t, p in both if p]
    assert ranges.avg_tax_pct_of_price == round(sum(shares) / len(shares) * 100, 1)


def test_disposition_leaves_missing_numbers_undecided(rows, report):
    found = report["disposition"].first()
    bad, good = 0, Counter()
    for r in rows:
        flags = [None if r.price is None else number(r.price) is None,
                 None if r.tax is None else number(r.tax) is None,
                 number(r.quantity) is None]
        if any(f for f in flags):
            bad += 1
        elif None not in flags:
            good[blank(r.customer_id)] += 1
    assert (found.would_quarantine, found.clean_but_flagged, found.fully_clean) == (bad, good[True], good[False])
    histogram = {r.issues_on_row: r.n_rows for r in report["issues_per_row"].collect()}
    assert sum(histogram.values()) == 300 and None in histogram


def test_tax_buckets(feed):
    raw = feed(
        {"tax": "1", "price": "10", "quantity": "1"},  # 10 %
        {"tax": "1.25", "price": "10", "quantity": "1"},  # 12.5 % rounds up to 15
        {"tax": "1.2499", "price": "10", "quantity": "2"},  # 12.499 %; 6.2495 % of the subtotal
        {"tax": "1", "price": "0", "quantity": "1"},
        {"tax": "x", "price": "10", "quantity": "1"},
    )
    of_price = {tuple(r) for r in profiling.tax_percent_of_price(raw).collect()}
    assert of_price == {(10, 2), (15, 1), (None, 1)}
    of_subtotal = {tuple(r) for r in profiling.tax_percent_of_subtotal(raw).collect()}
    assert of_subtotal == {(10, 1), (15, 1), (5, 1), (None, 1)}


def test_correlation_of_a_rate(feed):
    raw = feed(*[{"tax": str(n), "price": str(10 * n), "quantity": "2"} for n in range(1, 9)])
    found = profiling.ask(raw, "tax_correlation").first()
    assert tuple(found) == (Decimal("1.000"), Decimal("1.000"))


def test_correlation_of_a_constant_is_null(feed):
    raw = feed(*[{"tax": "1", "price": str(n), "quantity": "2"} for n in range(1, 9)])
    assert tuple(profiling.ask(raw, "tax_correlation").first()) == (None, None)
    assert tuple(profiling.ask(raw.where("false"), "tax_correlation").first()) == (None, None)
    assert profiling.ask(raw.limit(1), "tax_summary").first().stddev is None
