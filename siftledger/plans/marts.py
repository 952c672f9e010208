"""Star schema and quarantine."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftledger.functions import dates
from siftledger.operators.spine import date_spine
from siftledger.schemas import FACT, QUARANTINE, UNKNOWN_CUSTOMER

# Default calendar window; the end is not part of it.
SPINE_START = "2020-01-01"
SPINE_END = "2031-01-01"


def valid_transactions(staged: DataFrame) -> DataFrame:
    """Valid rows only; a missing customer becomes the unknown member."""
    return staged.where("is_valid").select(
        "transaction_id",
        F.coalesce("customer_id", F.lit(UNKNOWN_CUSTOMER).cast("long")).alias("customer_id"),
        "product_id",
        "product_name",
        "transaction_date",
        dates.date_key(F.col("transaction_date")).alias("date_key"),
        "quantity",
        "unit_price",
        "subtotal",
        "tax_amount",
        "total_amount",
        "missing_customer",
        "_ingested_at",
    )


def fct_transactions(valid: DataFrame) -> DataFrame:
    return valid.select(*FACT.schema.names)


def dim_product(valid: DataFrame) -> DataFrame:
    """Distinct id and name. Two names for one id give two rows, which the key check reports."""
    return valid.select("product_id", "product_name").distinct()


def dim_customer(valid: DataFrame) -> DataFrame:
    """Known customers, and the unknown member whether or not it is used."""
    known = (
        valid.select("customer_id")
        .where(F.col("customer_id") != UNKNOWN_CUSTOMER)
        .distinct()
        .select("customer_id", F.lit(False).alias("is_unknown"))
    )
    unknown = valid.sparkSession.range(1).select(
        F.lit(UNKNOWN_CUSTOMER).cast("long").alias("customer_id"), F.lit(True).alias("is_unknown")
    )
    return known.unionByName(unknown)


def dim_date(
    spark: SparkSession, start: Column | str = SPINE_START, end: Column | str = SPINE_END
) -> DataFrame:
    day = F.col("date_day")
    return date_spine(spark, start, end).select(
        dates.date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.date_format(day, "MMM").alias("month_name"),
        dates.iso_day_of_week(day).alias("day_of_week"),
    )


def quarantine(staged: DataFrame, run_ts: datetime | str) -> DataFrame:
    """Rejected rows as received, with the reasons and the time of the run."""
    return staged.where("NOT is_valid").select(
        *[c for c in QUARANTINE.schema.names if c != "_quarantined_at"],
        F.lit(run_ts).cast("timestamp").alias("_quarantined_at"),
    )
