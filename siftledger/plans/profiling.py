"""Questions about the raw feed, asked before any rule is trusted.

A question with one answer row is a set of aggregates over ``raw``; those without
distinct counts can be answered together, in one scan (:func:`overview`). Distinct
counts stay apart, each reading its own column: combined, they would multiply every
row once per counted column. Questions with many answer rows are grouped and sorted.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftledger.functions import coerce
from siftledger.functions.exact import ratio_half_up
from siftledger.plans.staging import PRODUCT_PREFIX, TRANSACTION_PREFIX
from siftledger.schemas import MONEY
from siftledger.session import materialise

# Text forms asked about only here, and the bucket width in percent.
FLOAT_FORM = r"^[0-9]+\.0+\z"
ZERO = r"^0+(\.0+)?\z"
PERCENT_STEP = 5


def _missing(column: str) -> Column:
    return coerce.is_blank(F.col(column))


def _numeric(column: str) -> Column:
    return coerce.is_number(F.col(column))


def _number(column: str) -> Column:
    return coerce.decimal_number(F.col(column))


def _bare_transaction_id() -> Column:
    return coerce.without_prefix(F.col("transaction_id"), TRANSACTION_PREFIX)


def _bare_product_id() -> Column:
    return coerce.without_prefix(F.col("product_id"), PRODUCT_PREFIX)


def _double_rounded(value: Column, digits: int) -> Column:
    """Statistics computed in floating point are rounded as decimals."""
    return F.round(value.cast(T.DecimalType(38, 12)), digits).cast(T.DecimalType(28, digits))


def _correlation(x: Column, y: Column) -> Column:
    """Pearson correlation of the rows with both values; NULL when one never varies.

    Built from its parts because ``corr`` itself divides by zero in that case.
    """
    x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    spread = F.stddev_pop(x) * F.stddev_pop(y)
    return F.covar_pop(x, y) / F.nullif(spread, F.lit(0.0))


# One answer row, no distinct counts: name -> aggregates.


def total_rows() -> list[Column]:
    return [F.count("*").alias("total_rows")]


def missing_per_column() -> list[Column]:
    names = {
        "tx_id_missing": "transaction_id",
        "customer_id_missing": "customer_id",
        "date_missing": "transaction_date",
        "product_id_missing": "product_id",
        "product_name_missing": "product_name",
        "quantity_missing": "quantity",
        "price_missing": "price",
        "tax_missing": "tax",
    }
    return [F.count_if(_missing(column)).alias(name) for name, column in names.items()]


def date_formats() -> list[Column]:
    text = F.col("transaction_date")
    iso, day_first = text.rlike(coerce.ISO_DATE), text.rlike(coerce.DAY_FIRST_DATE)
    return [
        F.count_if(iso).alias("iso_ymd"),
        F.count_if(day_first).alias("dmy"),
        F.count_if(~iso & ~day_first).alias("other"),
    ]


def date_range() -> list[Column]:
    day = coerce.two_format_date(F.col("transaction_date"))
    return [F.min(day).alias("min_date"), F.max(day).alias("max_date")]


def quantity_forms() -> list[Column]:
    return [
        F.count_if(_missing("quantity")).alias("missing"),
        F.count_if(_numeric("quantity")).alias("numeric_vals"),
        F.count_if(F.col("quantity").rlike(coerce.DIGITS)).alias("integer_vals"),
        F.count_if(F.col("quantity").rlike(ZERO)).alias("zero_or_negative"),
    ]


def number_forms(column: str) -> list[Column]:
    return [
        F.count_if(_numeric(column)).alias("numeric_vals"),
        F.count_if(~_numeric(column)).alias("non_numeric_vals"),
    ]


def tax_and_price_ranges() -> list[Column]:
    both = _numeric("tax") & _numeric("price")
    tax, price = F.when(both, _number("tax")), F.when(both, _number("price"))
    share = (tax / F.nullif(price, F.lit(0).cast(MONEY))).cast(T.DecimalType(31, 12))
    return [
        F.round(F.min(tax), 2).alias("min_tax"),
        F.round(F.max(tax), 2).alias("max_tax"),
        ratio_half_up(F.sum(tax), F.count(tax), 2).alias("avg_tax"),
        F.round(F.min(price), 2).alias("min_price"),
        F.round(F.max(price), 2).alias("max_price"),
        ratio_half_up(F.sum(share) * 100, F.count(share), 1, scale=12).alias("avg_tax_pct_of_price"),
    ]


def _issues() -> dict[str, Column]:
    return {
        "bad_price": ~_numeric("price"),
        "bad_tax": ~_numeric("tax"),
        "bad_qty": _missing("quantity") | ~_numeric("quantity"),
        "missing_customer": _missing("customer_id"),
    }


def disposition() -> list[Column]:
    """A preview of the verdicts. A NULL price or tax is neither bad nor good here."""
    issue = _issues()
    broken = issue["bad_price"] | issue["bad_tax"] | issue["bad_qty"]
    return [
        F.count_if(broken).alias("would_quarantine"),
        F.count_if(~broken & issue["missing_customer"]).alias("clean_but_flagged"),
        F.count_if(~broken & ~issue["missing_customer"]).alias("fully_clean"),
        F.count("*").alias("total"),
    ]


def tax_summary() -> list[Column]:
    tax = _number("tax")
    return [
        F.count_if(_numeric("tax")).alias("n"),
        F.round(F.min(tax), 2).alias("min"),
        F.round(F.max(tax), 2).alias("max"),
        ratio_half_up(F.sum(tax), F.count(tax), 2).alias("avg"),
        _double_rounded(F.stddev_samp(tax), 2).alias("stddev"),
        F.count_if(F.col("tax").rlike(coerce.FLOAT_FORM_ID)).alias("whole_numbers"),
    ]


def tax_correlation() -> list[Column]:
    tax, price, quantity = (_number(c).cast("double") for c in ("tax", "price", "quantity"))
    return [
        _double_rounded(_correlation(tax, price), 3).alias("corr_tax_price"),
        _double_rounded(_correlation(tax, quantity * price), 3).alias("corr_tax_subtotal"),
    ]


ONE_SCAN: dict[str, Callable[[], list[Column]]] = {
    "total_rows": total_rows,
    "missing": missing_per_column,
    "date_formats": date_formats,
    "date_range": date_range,
    "quantity": quantity_forms,
    "price": lambda: number_forms("price"),
    "tax": lambda: number_forms("tax"),
    "tax_vs_price": tax_and_price_ranges,
    "disposition": disposition,
    "tax_summary": tax_summary,
    "tax_correlation": tax_correlation,
}


def ask(raw: DataFrame, question: str) -> DataFrame:
    """One question of :data:`ONE_SCAN` on its own."""
    return raw.agg(*ONE_SCAN[question]())


def overview(raw: DataFrame) -> DataFrame:
    """All questions of :data:`ONE_SCAN` in one scan: a row with a struct per question."""
    return raw.agg(*[F.struct(*columns()).alias(name) for name, columns in ONE_SCAN.items()])


# One answer row with a distinct count.


def transaction_ids(raw: DataFrame) -> DataFrame:
    bare = _bare_transaction_id()
    return raw.agg(
        F.count_if(F.col("transaction_id").startswith(TRANSACTION_PREFIX)).alias("t_prefixed"),
        F.count_if(bare.rlike(coerce.DIGITS)).alias("numeric_after_strip"),
        F.count_distinct(bare).alias("distinct_after_strip"),
        F.count("*").alias("total"),
    )


def customer_ids(raw: DataFrame) -> DataFrame:
    text = F.col("customer_id")
    return raw.agg(
        F.count_if(text.rlike(FLOAT_FORM)).alias("float_form"),
        F.count_if(text.rlike(coerce.DIGITS)).alias("int_form"),
        F.count_if(_missing("customer_id")).alias("missing"),
        F.count_distinct(text).alias("distinct_vals"),
    )


def product_ids(raw: DataFrame) -> DataFrame:
    return raw.agg(
        F.count_if(F.col("product_id").startswith(PRODUCT_PREFIX)).alias("p_prefixed"),
        F.count_distinct(_bare_product_id()).alias("distinct_after_strip"),
    )


# Many answer rows.


def duplicate_ids(raw: DataFrame) -> DataFrame:
    """Ids shared by rows, as text without prefix; rows without an id are one group."""
    return (
        raw.groupBy(_bare_transaction_id().alias("tx_id"))
        .agg(F.count("*").alias("n"))
        .where("n > 1")
        .orderBy(F.desc("n"), "tx_id")
    )


def product_names(raw: DataFrame) -> DataFrame:
    return (
        raw.groupBy(_bare_product_id().alias("pid"), "product_name")
        .agg(F.count("*").alias("n"))
        .orderBy("pid", "product_name")
    )


def bad_values(raw: DataFrame, column: str) -> DataFrame:
    return (
        raw.where(~_numeric(column))
        .groupBy(F.col(column).alias(f"bad_{column}_value"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), f"bad_{column}_value")
    )


def issues_per_row(raw: DataFrame) -> DataFrame:
    issue = _issues()
    counted = sum((flag.cast("int") for flag in issue.values()), F.lit(0))
    return (
        raw.groupBy(counted.alias("issues_on_row"))
        .agg(F.count("*").alias("n_rows"))
        .orderBy("issues_on_row")
    )


def tax_percent_of_price(raw: DataFrame) -> DataFrame:
    return _tax_percent(raw, ["price"], _number("price"), "pct_of_price_bucket")


def tax_percent_of_subtotal(raw: DataFrame) -> DataFrame:
    # Narrower than money, so that the product keeps all its decimals.
    quantity = coerce.decimal_number(F.col("quantity"), T.DecimalType(12, 4))
    subtotal = quantity * _number("price")
    return _tax_percent(raw, ["price", "quantity"], subtotal, "pct_of_subtotal_bucket")


def _tax_percent(raw: DataFrame, numeric: list[str], base: Column, bucket: str) -> DataFrame:
    """Rows by tax as a percentage of ``base``, to the nearest five; zero base is NULL."""
    for column in ["tax", *numeric]:
        raw = raw.where(_numeric(column))
    typed = raw.select((_number("tax") * F.lit(100 // PERCENT_STEP)).alias("top"), base.alias("base"))
    steps = ratio_half_up(F.col("top"), F.col("base"), 0, scale=10)
    return (
        typed.select(steps.alias("steps"))
        .groupBy((F.col("steps") * F.lit(PERCENT_STEP)).cast("long").alias(bucket))
        .agg(F.count("*").alias("n"))
        .orderBy(bucket)
    )


def profile(raw: DataFrame) -> dict[str, DataFrame]:
    """The whole report. The overview row is computed once, for all its questions."""
    row = materialise(overview(raw), "profile-overview")
    report = {name: row.select(f"{name}.*") for name in ONE_SCAN}
    report.update(
        transaction_ids=transaction_ids(raw),
        duplicate_ids=duplicate_ids(raw),
        customer_ids=customer_ids(raw),
        product_ids=product_ids(raw),
        product_names=product_names(raw),
        bad_prices=bad_values(raw, "price"),
        bad_taxes=bad_values(raw, "tax"),
        issues_per_row=issues_per_row(raw),
        tax_percent_of_price=tax_percent_of_price(raw),
        tax_percent_of_subtotal=tax_percent_of_subtotal(raw),
    )
    return report
