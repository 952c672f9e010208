"""Coercions and exact rounding, on literals and against plain Python."""

from __future__ import annotations

import random
import re
from datetime import date
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from siftledger.functions import coerce, dates
from siftledger.functions.exact import percent, ratio_half_up

def evaluate(spark, column, values, *more):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, text string")
    out = column(F.col("text"), *more).alias("out")
    return [r.out for r in rows.select("i", out).orderBy("i").collect()]


@pytest.mark.parametrize(
    ("column", "cases"),
    [
        (
            coerce.prefixed_id,
            {"7": 7, "T7": 7, "TT7": None, "t7": None, "X7": None, "": None, None: None, "7 ": None,
             "7\n": None, "+7": None, "T": None, "007": 7, "99999999999999999999": None,
             "9223372036854775807": 9223372036854775807},
        ),
        (
            coerce.float_form_id,
            {"501.0": 501, "501": 501, "501.000": 501, "501.5": None, "501.": None, ".0": None,
             "501.0.0": None, "501.0\n": None, "": None, None: None, "abc": None, "5e2": None},
        ),
        (
            coerce.rounded_integer,
            {"1.0": 1, "2.5": 3, "0.4": 0, "0.5": 1, "2.49999": 2, "2.4999999999999999999999": 2,
             "3": 3, "-1": None, "1e3": None, ".5": None, "5.": None, "1,000": None, "": None,
             None: None, "2147483647": 2147483647, "2147483647.5": None, "2147483648": None,
             "99999999999999999999.5": None, "1.5\n": None},
        ),
        (
            coerce.decimal_number,
            {"18.40": Decimal("18.400000"), "3": Decimal("3.000000"), "on request": None, "-7.25": None,
             "1.0 ": None, "1.1234567": Decimal("1.123457"), "1" * 18: Decimal("1" * 18), "1" * 19: None, "": None, None: None},
        ),
        (
            coerce.two_format_date,
            {"2023-07-11": date(2023, 7, 11), "18-07-2023": date(2023, 7, 18), "2023-02-30": None,
             "30-02-2023": None, "2024-02-29": date(2024, 2, 29), "2024/01/06": None,
             "2024-1-6": None, "2024-01-06 ": None, "2024-01-06\n": None, "": None, None: None},
        ),
        (
            coerce.trimmed_or_null,
            {" Widget ": "Widget", "   ": None, "": None, None: None, "\tx": "\tx"},
        ),
    ],
    ids=lambda v: getattr(v, "__name__", ""),
)
def test_coercion(spark, column, cases):
    more = ("T",) if column is coerce.prefixed_id else ()
    assert dict(zip(cases, evaluate(spark, column, cases, *more))) == cases


def test_rounding_agrees_with_decimal_arithmetic(spark):
    pick = random.Random(7)
    texts = [
        f"{pick.randrange(10**pick.randrange(1, 11))}.{''.join(pick.choices('0459', k=pick.randrange(1, 20)))}"
        for _ in range(500)
    ]
    expected = [int(Decimal(t).quantize(Decimal(1), ROUND_HALF_UP)) for t in texts]
    expected = [v if v < 2**31 else None for v in expected]
    assert evaluate(spark, coerce.rounded_integer, texts) == expected


def test_random_text_never_raises_and_matches_the_patterns(spark):
    pick = random.Random(11)
    texts = ["".join(pick.choices("0159.TP- \n", k=pick.randrange(0, 12))) for _ in range(2000)]
    numbers = evaluate(spark, coerce.decimal_number, texts)
    ids = evaluate(spark, coerce.prefixed_id, texts, "T")
    floats = evaluate(spark, coerce.float_form_id, texts)
    evaluate(spark, coerce.two_format_date, texts)
    for text, number, key, loose in zip(texts, numbers, ids, floats):
        assert (number is not None) == bool(re.fullmatch(r"[0-9]+(\.[0-9]+)?", text))
        assert key == (int(text.removeprefix("T")) if re.fullmatch("T?[0-9]+", text) else None)
        stripped = re.sub(r"\.0+\Z", "", text)
        assert loose == (int(stripped) if re.fullmatch("[0-9]+", stripped) else None)


def test_ratio_rounds_once(spark):
    pick = random.Random(3)
    pairs = [(pick.randrange(10**12), pick.randrange(1, 10**6)) for _ in range(300)]
    # 2.49499999999 must not become 2.4950 and then 2.50.
    pairs += [(249499999999, 100000000000), (5, 1000), (0, 7), (15, 1000), (1, 3)]
    rows = spark.createDataFrame(pairs, "n long, d long")
    out = rows.select("n", "d", ratio_half_up(F.col("n"), F.col("d"), 2).alias("r")).collect()
    for row in out:
        units = (Fraction(row.n, row.d) * 100 + Fraction(1, 2)).__floor__()
        assert row.r == Decimal(units) / 100


def test_ratio_without_denominator_is_null(spark):
    rows = spark.createDataFrame([(1, 0), (1, None)], "n long, d long")
    assert [r.r for r in rows.select(percent(F.col("n"), F.col("d")).alias("r")).collect()] == [None, None]


def test_percent_of_large_decimals(spark):
    rows = spark.sql(
        "SELECT CAST('7000000000000000000.1234' AS DECIMAL(38,4)) AS part, "
        "CAST('21000000000000000000.0000' AS DECIMAL(38,4)) AS whole"
    )
    assert rows.select(percent(F.col("part"), F.col("whole")).alias("p")).first().p == Decimal("33.3")


def test_calendar_parts(spark):
    row = spark.sql("SELECT DATE'2023-07-16' AS d").select(
        dates.date_key(F.col("d")).alias("key"),
        dates.month_start(F.col("d")).alias("month"),
        dates.iso_day_of_week(F.col("d")).alias("dow"),
    ).first()
    assert tuple(row) == (20230716, date(2023, 7, 1), 7)
