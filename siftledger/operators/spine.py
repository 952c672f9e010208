"""Calendar spine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def date_spine(spark: SparkSession, start: Column | str, end: Column | str) -> DataFrame:
    """One row ``date_day`` per day from ``start`` up to, and without, ``end``.

    Bounds are ISO text or date columns, for example a scalar subquery over a fact.
    """
    first, after = (F.lit(b).cast("date") if isinstance(b, str) else b for b in (start, end))
    days = F.sequence(first, F.date_sub(after, 1))
    return spark.range(1).select(F.explode(days).alias("date_day"))
