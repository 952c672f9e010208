"""Exact rounding of quotients.

Decimal division keeps a limited number of digits, so rounding its result rounds
twice and can turn 2.4949999 into 2.50. Here the quotient is cut to a whole number by
its remainder instead, which is exact for any row count.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ratio_half_up(numerator: Column, denominator: Column, digits: int, scale: int = 6) -> Column:
    """``numerator / denominator`` rounded half up to ``digits`` places.

    Both sides are non-negative with at most ``scale`` decimals. A zero or NULL
    denominator gives NULL.
    """
    working = T.DecimalType(38, scale)
    top = numerator.cast(working)
    bottom = F.nullif(denominator.cast(working), F.lit(0).cast(working))
    # floor(n/d * 10^digits + 1/2) = floor((2 * 10^digits * n + d) / 2d)
    shifted = (top * F.lit(2 * 10**digits)).cast(working) + bottom
    step = bottom * F.lit(2)
    units = ((shifted - shifted % step) / step).cast(T.DecimalType(28, 0))
    return (units / F.lit(10**digits)).cast(T.DecimalType(28, digits))


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """``part`` as a percentage of ``whole``."""
    return ratio_half_up(part * F.lit(100), whole, digits)
