"""Turn typed rows into verdicts: which rules a row breaks, and what follows.

A rule is a code and a predicate over typed columns. The order of the rules is the
order of the codes in ``dq_reasons``. A new rule is a new entry here; the vocabulary
check compares the codes in use with the declared ones.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftledger.schemas import SUBTOTAL, TOTAL


@dataclass(frozen=True)
class Rule:
    code: str
    broken: str


# A number by its text, and one that is not zero; asked only where the typed value is
# missing or zero.
_NUMBER = "RLIKE r'^[0-9]+([.][0-9]+)?\\z'"
_NOT_ZERO = "RLIKE '[1-9]'"

DEFAULT_RULES = (
    # Not readable as its type.
    Rule("price_not_numeric", f"unit_price IS NULL AND NOT coalesce(price_raw {_NUMBER}, false)"),
    Rule("tax_not_numeric", f"tax_amount IS NULL AND NOT coalesce(tax_raw {_NUMBER}, false)"),
    Rule("quantity_missing_or_invalid", "quantity IS NULL"),
    Rule("date_unparseable", "transaction_date IS NULL"),
    Rule("transaction_id_invalid", "transaction_id IS NULL"),
    # Readable, but not acceptable. Signs never pass coercion, so tax_negative stays
    # silent on feeds read by this library; its code is still part of the vocabulary.
    Rule("price_non_positive", f"unit_price <= 0 AND NOT price_raw {_NOT_ZERO}"),
    Rule("tax_negative", "tax_amount < 0"),
    Rule("quantity_non_positive", "quantity <= 0"),
    # More than one row for one id.
    Rule("duplicate_transaction_id", "is_duplicate_id"),
    # Numbers, but none that the money type holds: too large, or rounded to nothing.
    Rule(
        "price_out_of_range",
        f"(unit_price IS NULL AND price_raw {_NUMBER}) OR (unit_price = 0 AND price_raw {_NOT_ZERO})",
    ),
    Rule("tax_out_of_range", f"tax_amount IS NULL AND tax_raw {_NUMBER}"),
)


def classify(typed: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES) -> DataFrame:
    """Add the verdict and the derived amounts to typed rows with ``is_duplicate_id``.

    No row is dropped. A missing customer is a soft flag, not a reason.
    """
    # Text placeholders instead of NULLs: array_remove is generated code, a filter over
    # array elements is not. The verdict reads the array, so that a reader's filter on it
    # stays one comparison and does not pull the coercions into a second evaluation.
    codes = [F.when(F.expr(rule.broken), F.lit(rule.code)).otherwise("") for rule in rules]
    subtotal = F.col("quantity") * F.col("unit_price")
    return typed.withColumns(
        {
            "dq_reasons": F.array_remove(F.array(*codes), ""),
            "missing_customer": F.col("customer_id").isNull(),
            "subtotal": subtotal.cast(SUBTOTAL),
            "total_amount": (subtotal + F.col("tax_amount")).cast(TOTAL),
        }
    ).withColumn("is_valid", F.size("dq_reasons") == 0)
