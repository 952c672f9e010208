"""Exact distinct counts that can be merged: ids as bits of blocks.

A block is 32,768 ids in four kilobytes, whatever the number of rows, built per task before
the shuffle. Bitmaps of parts are merged by OR, so the distinct ids of any union of parts
follow from what is stored. That suits ids given out in sequence; ids scattered over the
whole range of numbers take a block each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def id_bitmaps(rows: DataFrame, groups: Sequence[str], key: str) -> DataFrame:
    """``groups``, block and bits: the non-NULL ids of each group. Negative ids are ids too."""
    return (
        rows.where(F.col(key).isNotNull())
        .groupBy(*groups, F.bitmap_bucket_number(key).alias("block"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("bits"))
    )


def distinct_in_bitmaps(bitmaps: DataFrame, groups: Sequence[str], name: str) -> DataFrame:
    """Distinct ids per group of ``groups``, over all bitmaps of the group, as ``name``."""
    merged = bitmaps.groupBy(*groups, "block").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*groups).agg(F.sum(F.bitmap_count("bits")).alias(name))
