"""From raw text to typed, judged rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftledger.functions import coerce
from siftledger.operators.classify import DEFAULT_RULES, Rule, classify
from siftledger.operators.duplicates import (
    MAX_BROADCAST_KEYS,
    MIN_HOT_ROWS,
    mark_repeated,
    repeated_keys,
)
from siftledger.schemas import MONEY, RAW_COLUMNS, STAGED
from siftledger.session import materialise

# Id prefixes of the feed.
TRANSACTION_PREFIX = "T"
PRODUCT_PREFIX = "P"


def coerced(
    raw: DataFrame, money: T.DecimalType = MONEY, kept: Sequence[str] = ()
) -> DataFrame:
    """The raw columns under ``*_raw`` names, next to their typed values and the ``kept`` columns."""
    return raw.select(
        *[F.col(name).alias(f"{name}_raw") for name in RAW_COLUMNS],
        typed_transaction_id(),
        coerce.float_form_id(F.col("customer_id")).alias("customer_id"),
        coerce.two_format_date(F.col("transaction_date")).alias("transaction_date"),
        coerce.prefixed_id(F.col("product_id"), PRODUCT_PREFIX).alias("product_id"),
        coerce.trimmed_or_null(F.col("product_name")).alias("product_name"),
        coerce.rounded_integer(F.col("quantity")).alias("quantity"),
        coerce.decimal_number(F.col("price"), money).alias("unit_price"),
        coerce.decimal_number(F.col("tax"), money).alias("tax_amount"),
        "_ingested_at",
        "_source_file",
        *kept,
    )


def typed_transaction_id():
    text = F.col("transaction_id")
    return coerce.prefixed_id(text, TRANSACTION_PREFIX).alias("transaction_id")


def repeated_transaction_ids(raw: DataFrame) -> DataFrame:
    """Typed transaction ids held by more than one raw row; reads one column of ``raw``."""
    return repeated_keys(raw.select(typed_transaction_id()), "transaction_id")


def staged(
    raw: DataFrame,
    repeated: DataFrame | None = None,
    rules: Sequence[Rule] = DEFAULT_RULES,
    max_broadcast_keys: int = MAX_BROADCAST_KEYS,
    min_hot_rows: int = MIN_HOT_ROWS,
    stored: bool = False,
) -> DataFrame:
    """Every raw row with typed values and verdict.

    ``repeated`` is the stored result of :func:`repeated_transaction_ids`; without it
    that small table is computed and written to the shared folder here. ``stored``: ``raw`` is
    a scan of files and all rows are stored as they are, so the text alone is marked, by place
    or else by a shuffle; typed values follow. A reader's filter on the verdict would then
    coerce every value twice.
    """
    if repeated is None:
        repeated = materialise(repeated_transaction_ids(raw), "repeated-ids")
    key = "_typed_id" if stored else "transaction_id"
    rows = raw.select("*", typed_transaction_id().alias(key)) if stored else coerced(raw)
    keys = repeated.withColumnRenamed("transaction_id", key)
    marked = mark_repeated(
        rows, key, keys, "is_duplicate_id", max_broadcast_keys, min_hot_rows, by_place=stored
    )
    if stored:
        marked = coerced(marked, kept=(key, "is_duplicate_id")).withColumn("transaction_id", F.col(key))
    return classify(marked, rules).select(*STAGED.schema.names)
