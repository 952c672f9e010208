"""Recover typed values from dirty text; whatever cannot be recovered becomes NULL.

Patterns end in ``\\z`` because ``$`` would also accept a trailing newline. Each
pattern is tested before the cast: a bare ``try_cast`` would accept blanks, signs and
exponents that the feed's rules do not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftledger.schemas import MONEY

# Accepted text forms.
DIGITS = r"^[0-9]+\z"
NUMBER = r"^[0-9]+(\.[0-9]+)?\z"
FLOAT_FORM_ID = r"^[0-9]+(\.0+)?\z"
ISO_DATE = r"^\d{4}-\d{2}-\d{2}\z"
DAY_FIRST_DATE = r"^\d{2}-\d{2}-\d{4}\z"


def without_prefix(text: Column, prefix: str) -> Column:
    """Drop one leading ``prefix`` (``TT16`` keeps its second ``T``)."""
    tail = F.substring(text, len(prefix) + 1, 2**31 - 1)
    return F.when(text.startswith(prefix), tail).otherwise(text)


def whole_number(text: Column) -> Column:
    """All digits, within 64 bits; otherwise NULL."""
    return F.when(text.rlike(DIGITS), text.try_cast(T.LongType()))


def prefixed_id(text: Column, prefix: str) -> Column:
    return whole_number(without_prefix(text, prefix))


def float_form_id(text: Column) -> Column:
    """``84.0`` and ``84`` are 84; ``84.5`` is not an id."""
    return F.when(text.rlike(FLOAT_FORM_ID), _before_point(text).try_cast(T.LongType()))


def _before_point(text: Column) -> Column:
    return F.substring_index(text, ".", 1)


def is_number(text: Column) -> Column:
    """Unsigned plain decimal notation; NULL stays NULL."""
    return text.rlike(NUMBER)


def decimal_number(text: Column, dtype: T.DecimalType = MONEY) -> Column:
    return F.when(is_number(text), text.try_cast(dtype))


def rounded_integer(text: Column) -> Column:
    """Unsigned number rounded half up to a 32-bit integer.

    Read from the digits rather than through a decimal, which would round twice
    (2.49999 would first become 2.5000).
    """
    point = F.instr(text, ".")
    rounds_up = (point > 0) & (F.substring(text, point + 1, 1) >= "5")
    rounded = F.try_add(_before_point(text).try_cast(T.LongType()), rounds_up.cast("long"))
    return F.when(is_number(text), rounded.try_cast(T.IntegerType()))


def two_format_date(text: Column) -> Column:
    """Year-first or day-first; a well-shaped day that does not exist is NULL."""
    day, month, year = (F.substring(text, start, size) for start, size in ((1, 2), (4, 2), (7, 4)))
    year_first = F.when(text.rlike(ISO_DATE), text).when(
        text.rlike(DAY_FIRST_DATE), F.concat_ws("-", year, month, day)
    )
    return year_first.try_cast(T.DateType())


def trimmed_or_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def is_blank(text: Column) -> Column:
    return text.isNull() | (F.trim(text) == "")
