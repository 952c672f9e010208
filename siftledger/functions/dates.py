"""Calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column) -> Column:
    """20230711 for 11 July 2023."""
    return F.date_format(day, "yyyyMMdd").cast("int")


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def iso_day_of_week(day: Column) -> Column:
    """1 is Monday, 7 is Sunday."""
    return F.weekday(day) + 1
