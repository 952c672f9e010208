"""Shards of near equal bytes by histogram sort.

The rows are ordered by a key. Bytes below candidate boundaries are counted exactly, in
one aggregation per round over all rows, and each splitter's interval of keys is narrowed
to the probe interval that holds its target, until the count is within tolerance. Then
the rows are exchanged once, by shard and key range.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftledger.llm.common import (
    HASH_BITS,
    hash63,
    shuffle_partitions,
    table,
    utf8,
    with_ordinal,
)
from siftledger.session import materialise

SHARDS = 8
# Part of a shard's bytes by which a splitter may miss its target.
TOLERANCE = 0.01
PROBES = 512

_END = 1 << HASH_BITS


@dataclass
class _Splitter:
    """Where a shard begins: the first key, and the first tie within that key."""

    target: float
    below: int = 0
    low: int = 0
    high: int = _END
    key: int | None = None  # set once a single key value holds the target
    at: tuple[int, int] | None = None

    @property
    def interval(self) -> tuple[int | None, int, int]:
        return self.key, self.low, self.high


def _step(low: int, high: int, probes: int) -> int:
    return -(-(high - low) // probes)


def _bin(intervals: list, probes: int, key: Column, tie: Column) -> Column:
    """The number of the probe interval a row falls into; NULL outside all."""
    found = None
    for i, (of, low, high) in enumerate(intervals):
        axis = key if of is None else tie
        inside = (axis >= low) & (axis <= high - 1)
        if of is not None:
            inside = inside & (key == of)
        number = F.lit(i * probes) + _div(axis - F.lit(low), _step(low, high, probes))
        found = F.when(inside, number) if found is None else found.when(inside, number)
    return found


def _div(x: Column, by: int) -> Column:
    return F.call_function("div", x, F.lit(by))


def splitters(
    df: DataFrame,
    size: str,
    key: str,
    tie: str,
    shards: int = SHARDS,
    tolerance: float = TOLERANCE,
    probes: int = PROBES,
) -> list[tuple[int, int]]:
    """(key, tie) at which shards 1 to ``shards`` - 1 begin.

    Boundaries between keys are taken where one is within tolerance, so that rows of one
    key stay together; a key too large for that is cut at a tie. Per round at most
    ``shards * probes`` counts reach the driver.
    """
    total = df.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    allowed = tolerance * total / shards
    wanted = [_Splitter(total * i / shards) for i in range(1, shards)]
    while open_ := [s for s in wanted if s.at is None]:
        intervals = list(dict.fromkeys(s.interval for s in open_))
        bins = (
            df.select(_bin(intervals, probes, F.col(key), F.col(tie)).alias("bin"), size)
            .where("bin is not null")
            .groupBy("bin")
            .agg(F.sum(size).alias("bytes"))
        )
        counted = {r["bin"]: r["bytes"] for r in bins.collect()}
        for s in open_:
            _narrow(s, counted, intervals.index(s.interval) * probes, probes, allowed)
    return [s.at for s in wanted]


def _narrow(s: _Splitter, counted: dict, first: int, probes: int, allowed: float) -> None:
    step, below = _step(s.low, s.high, probes), s.below
    number = 0
    while number < probes - 1 and below + counted.get(first + number, 0) < s.target:
        below += counted.get(first + number, 0)
        number += 1
    inside = counted.get(first + number, 0)
    low, high = s.low + number * step, min(s.high, s.low + (number + 1) * step)
    under, over = s.target - below, below + inside - s.target
    last = s.key is not None and high - low <= 1
    if min(under, over) <= allowed or inside == 0 or last:
        begin = low if under <= over else high
        s.at = (begin, 0) if s.key is None else (s.key, begin)
    elif high - low <= 1:
        s.key, s.low, s.high, s.below = low, 0, _END, below
    else:
        s.low, s.high, s.below = low, high, below


def histogram_sort(
    df: DataFrame,
    size: str,
    key: str,
    tie: str,
    shards: int = SHARDS,
    tolerance: float = TOLERANCE,
    probes: int = PROBES,
) -> DataFrame:
    """Add ``shard`` and ``slot``: the row's place in its shard, from 0, in key order.

    ``key`` and ``tie`` are non-negative 63-bit numbers, spread evenly for distinct
    values (hashes); ``size`` is a positive number of bytes. ``df`` is read once per
    round and twice more, so it should be stored. Rows that agree in key and tie cannot
    be told apart and go to one shard. An empty table gives an empty result.
    """
    spark = df.sparkSession
    begins = splitters(df, size, key, tie, shards, tolerance, probes)
    shard = F.lit(0)
    for begin, first in begins:
        k, t = F.col(key), F.col(tie)
        reached = (k > min(begin, _END - 1)) | ((k == min(begin, _END - 1)) & (t >= first))
        shard = shard + (reached if begin < _END else F.lit(False)).cast("int")

    # Key ranges small enough for a task. A key with many rows is a range of its own,
    # cut further by the tie; there are at most half as many of those as ranges.
    bits = (4 * shuffle_partitions(spark) - 1).bit_length()
    ranges, shift = 1 << bits, HASH_BITS - bits
    rows = df.count()
    heavy = (
        df.groupBy(F.col(key).alias("_key"))
        .agg(F.count("*").alias("_n"))
        .where(F.col("_n") > 2 * rows / ranges)
        .groupBy(F.shiftright("_key", shift).alias("_range"))
        .agg(F.sort_array(F.collect_list("_key")).alias("_heavy"))
    )
    ranged = df.withColumn("_range", F.shiftright(key, shift)).join(
        F.broadcast(heavy), "_range", "left"
    )
    is_heavy = F.coalesce(F.array_contains("_heavy", F.col(key)), F.lit(False))
    smaller = F.coalesce(F.size(F.filter("_heavy", lambda x: x < F.col(key))), F.lit(0))
    ranged = ranged.select(
        *df.columns,
        shard.alias("shard"),
        "_range",
        (2 * F.when(F.col("_heavy").isNull(), 0).otherwise(smaller) + is_heavy.cast("int")).alias(
            "_part"
        ),
        F.when(is_heavy, F.shiftright(tie, shift)).otherwise(F.lit(0)).alias("_cut"),
    )
    numbered = with_ordinal(ranged, ["shard"], ["_range", "_part", "_cut"], [key, tie], "slot")
    return numbered.drop("_range", "_part", "_cut")


def sharded(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every document.

    Size: UTF-8 bytes of the text and 1; a NULL text has none, and crc 0. Documents are
    ordered by a hash of their text, so equal texts are neighbours and share a shard
    unless they outweigh the tolerance at a boundary; within a text by a hash of the id,
    NULL included. Repeated rows keep a slot each. Other columns are not read.
    """
    body = utf8("text")
    keyed = docs.select(
        F.col("doc_id"),
        (F.octet_length(body) + F.lit(1)).cast("long").alias("size"),
        F.crc32(body).cast("long").alias("text_crc32"),
        hash63(body).alias("_text_key"),
        hash63(F.col("doc_id"), F.lit("tie")).alias("_id_key"),
    )
    stored = materialise(keyed, "shard-keys")
    return histogram_sort(stored, "size", "_text_key", "_id_key", shards, tolerance)


def query(spark: SparkSession, folder: str) -> DataFrame:
    return sharded(table(spark, folder, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
