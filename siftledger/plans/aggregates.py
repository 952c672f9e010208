"""Sales summaries over the fact.

Every ``groupBy`` here aggregates per map task before it shuffles, distinct counts
included, so a month, customer or product with a third of all rows costs no more
shuffle than any other. Averages are taken from sums and counts, exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftledger.functions.dates import month_start
from siftledger.functions.exact import percent, ratio_half_up
from siftledger.operators.bitmaps import distinct_in_bitmaps, id_bitmaps
from siftledger.schemas import UNKNOWN_CUSTOMER
from siftledger.session import materialise


def _totals() -> list[Column]:
    return [
        F.count("*").alias("num_transactions"),
        F.sum("quantity").alias("total_quantity"),
        F.sum("subtotal").alias("total_subtotal"),
        F.sum("tax_amount").alias("total_tax"),
        F.sum("total_amount").alias("total_amount"),
    ]


def _per_transaction(total: str) -> Column:
    return ratio_half_up(F.col(total), F.col("num_transactions"), 2)


def monthly_sales(fact: DataFrame) -> DataFrame:
    customer = F.col("customer_id")
    return _monthly(
        fact.groupBy(month_start(F.col("transaction_date")).alias("month")).agg(
            F.count_distinct(F.when(customer != UNKNOWN_CUSTOMER, customer)).alias("num_customers"),
            F.count_distinct("product_id").alias("distinct_products"),
            *_totals(),
        )
    )


def monthly_sales_of(fact: DataFrame, ids: DataFrame) -> DataFrame:
    """:func:`monthly_sales` with the distinct counts of ``ids``, the stored rows of
    :func:`monthly_ids` over the same fact: its rows are then added up per task, and no
    customer or product is shuffled again."""
    totals = fact.groupBy(month_start(F.col("transaction_date")).alias("month")).agg(*_totals())
    named = ids.withColumnRenamed("month", "_month")
    distinct = distinct_over(named, F.col("_month").alias("month"))
    counts = totals.join(distinct, "month", "left")
    return _monthly(counts.na.fill(0, ["num_customers", "distinct_products"]))


def _monthly(counts: DataFrame) -> DataFrame:
    return counts.select(
        "month",
        "num_transactions",
        "num_customers",
        "distinct_products",
        "total_quantity",
        "total_subtotal",
        "total_tax",
        "total_amount",
        _per_transaction("total_amount").alias("avg_transaction_value"),
        _per_transaction("total_quantity").alias("avg_units_per_transaction"),
    )


def monthly_ids(fact: DataFrame) -> DataFrame:
    """The known customers and the products of each month, as bitmaps of blocks of ids."""
    customer = F.when(F.col("customer_id") != UNKNOWN_CUSTOMER, F.col("customer_id"))
    kinds = {"customer": customer, "product": F.col("product_id")}
    both = F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("id")) for k, v in kinds.items()])
    month = month_start(F.col("transaction_date")).cast("date")
    ids = fact.select(month.alias("month"), F.inline(both))
    return id_bitmaps(ids, ["month", "kind"], "id")


def distinct_over(ids: DataFrame, *periods: Column) -> DataFrame:
    """Known customers and products per period, from the stored bitmaps of its months.

    ``ids``: rows of :func:`monthly_ids`, filtered as wished; ``periods`` are expressions
    over month. Counts are exact although months share customers: bitmaps are merged.
    """
    named = [F.col(p) if isinstance(p, str) else p for p in periods]
    of_period = ids.select("*", *named)
    names = [c for c in of_period.columns if c not in ids.columns]
    counts = distinct_in_bitmaps(of_period, [*names, "kind"], "n")
    both = [
        F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0)).alias(name)
        for kind, name in (("customer", "num_customers"), ("product", "distinct_products"))
    ]
    return counts.groupBy(*names).agg(*both)


def sales_by_customer(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("customer_id")
        .agg(
            F.count_distinct("product_id").alias("distinct_products"),
            *_totals(),
            F.min("transaction_date").alias("first_transaction_date"),
            F.max("transaction_date").alias("last_transaction_date"),
        )
        .select(
            "customer_id",
            (F.col("customer_id") == UNKNOWN_CUSTOMER).alias("is_unknown"),
            "num_transactions",
            "distinct_products",
            "total_quantity",
            "total_subtotal",
            "total_tax",
            "total_amount",
            _per_transaction("total_amount").alias("avg_transaction_value"),
            "first_transaction_date",
            "last_transaction_date",
        )
    )


def product_totals(fact: DataFrame) -> DataFrame:
    """One row per product id, before names and shares are attached."""
    return fact.groupBy("product_id").agg(*_totals(), F.sum("unit_price").alias("price_sum"))


def sales_by_product(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Totals, average price and revenue share per product.

    The fact is summed per product id first, so the join with the dimension sees one
    row per product instead of one per transaction. Those rows are written once: they
    give both the result and the grand total, and the fact is scanned a single time.
    """
    return product_sales(product_totals(fact), products)


def product_sales(totals: DataFrame, products: DataFrame) -> DataFrame:
    """Names, average prices and revenue shares for the rows of :func:`product_totals`."""
    named = materialise(
        totals.join(products.select("product_id", "product_name"), "product_id"), "product-totals"
    )
    revenue = named.agg(F.sum("total_amount")).scalar()
    return named.select(
        "product_id",
        "product_name",
        "num_transactions",
        "total_quantity",
        "total_subtotal",
        "total_tax",
        "total_amount",
        _per_transaction("price_sum").alias("avg_unit_price"),
        percent(F.col("total_amount"), revenue).alias("revenue_share_pct"),
    )
