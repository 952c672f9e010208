"""Find keys held by more than one row, and mark every row that holds one.

A window partitioned by the key would shuffle and sort whole rows, and would put every
row of a hot key, and every row without a key, into one task. Here only the key column
is shuffled, already counted per map task, so a hot key arrives as one record per task.
The rows themselves then pass through a broadcast join, without a shuffle, whenever the
repeated keys are few; otherwise the most repeated are broadcast and the others joined, in
one scan and one shuffle without a hot group. Stored rows need not move even then: their
keys are joined, and the places of the rows found are broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftledger.operators import places

# Keys a broadcast may hold: a million 64-bit keys are about 32 MB per executor.
MAX_BROADCAST_KEYS = 1_000_000
# A key below this many rows is small enough to meet its match in one shuffle task.
MIN_HOT_ROWS = 1_000_000


def repeated_keys(rows: DataFrame, key: str) -> DataFrame:
    """``key`` and ``n_rows`` for every non-NULL key held by more than one row.

    Counting the key itself gives the rows without one a count of zero, so they fall out
    after the aggregation; a filter before it would compute every key twice.
    """
    return rows.groupBy(key).agg(F.count(key).alias("n_rows")).where("n_rows > 1")


def mark_repeated(
    rows: DataFrame,
    key: str,
    repeated: DataFrame,
    flag: str,
    max_broadcast_keys: int = MAX_BROADCAST_KEYS,
    min_hot_rows: int = MIN_HOT_ROWS,
    by_place: bool = False,
) -> DataFrame:
    """Add the boolean ``flag``: true where ``key`` is one of the ``repeated`` keys.

    ``repeated`` comes from :func:`repeated_keys` and should be materialised: its size
    is measured here, and it is joined afterwards. Rows without a key are never marked.
    Keys are whole numbers from 0. ``by_place``: the rows are a scan of files; where the
    places of all fit a broadcast, keys are joined with places instead of whole rows.
    """
    size = repeated.agg(F.count("*").alias("keys"), F.sum("n_rows").alias("rows")).first()
    if size["keys"] <= max_broadcast_keys:
        return _marked(rows, key, F.broadcast(repeated), flag)

    # At most max_broadcast_keys keys can each hold rows / max_broadcast_keys rows, so
    # the hot keys always fit a broadcast.
    hot_rows = max(min_hot_rows, size["rows"] // max_broadcast_keys + 1)
    hot = F.broadcast(repeated.where(F.col("n_rows") >= hot_rows))
    light = repeated.where(F.col("n_rows") < hot_rows)
    if by_place and places.can_be_marked(rows):
        placed = _marked(places.with_place(rows.select(key)), key, hot, flag).where(~F.col(flag))
        found = places.places(placed.join(light.select(key), key, "left_semi"))
        either = (F.col("_light") | F.col(flag)).alias(flag)
        checked = _marked(places.marked(rows, found, "_light"), key, hot, flag)
        return checked.select(*rows.columns, either)
    checked = _marked(rows, key, hot, flag)
    # Decided rows meet no key: each gets a negative number of its own, so they spread over
    # all tasks and one join serves all rows. The number is made from no column, so that
    # columns which no reader asks for are neither joined nor shuffled.
    decided = F.col(key).isNull() | F.col(flag)
    own = -1 - F.monotonically_increasing_id()
    found = light.select(F.col(key).alias("_light"), F.lit(True).alias("_found"))
    probed = checked.withColumn("_probe", F.when(decided, own).otherwise(F.col(key)))
    return probed.join(found, F.col("_probe") == F.col("_light"), "left").select(
        *rows.columns, (F.col(flag) | F.coalesce("_found", F.lit(False))).alias(flag)
    )


def _marked(rows: DataFrame, key: str, keys: DataFrame, flag: str) -> DataFrame:
    found = keys.select(F.col(key), F.lit(True).alias(flag))
    return rows.join(found, key, "left").select(
        *rows.columns, F.coalesce(F.col(flag), F.lit(False)).alias(flag)
    )
