"""What the corpus operators share: tables, hashes, gapless numbers, Arrow helpers."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from typing import TypeVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

T = TypeVar("T")

# Bits of the non-negative hashes that keys are spread by.
HASH_BITS = 63


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def hash63(*columns: Column | str) -> Column:
    """A non-negative 63-bit hash."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 1)


def utf8(text: Column | str) -> Column:
    """The bytes of a text; none for NULL."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("binary")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def arrow_batches_of(spark: SparkSession, size: int) -> Iterator[None]:
    """Within the block, Spark hands Python batches of about ``size`` bytes; a row may be more."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The given names, lengthened until none is a column of ``df``."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def with_ordinal(
    df: DataFrame, groups: list[str], buckets: list[str], order: list[str], name: str
) -> DataFrame:
    """Number the rows of each group from 0, without gaps, by ``buckets`` and then ``order``.

    The buckets of a group are counted first and their counts summed up, so a group of
    any size is numbered by as many tasks as it has buckets. ``df`` is read twice and
    must give the same rows both times; buckets must be few against rows.
    """
    before = Window.partitionBy(*groups, "_all").orderBy(*buckets)
    counts = (
        df.groupBy(*groups, *buckets)
        .agg(F.count("*").alias("_n"))
        .withColumn("_all", F.lit(0))
        .withColumn("_base", F.sum("_n").over(before) - F.col("_n"))
        .drop("_all", "_n")
    )
    keys = [*groups, *buckets]
    for key in keys:
        counts = counts.withColumnRenamed(key, f"_of_{key}")
    within = Window.partitionBy(*keys).orderBy(*order)
    numbered = df.withColumn("_at", F.row_number().over(within) - 1)
    same = [F.col(key).eqNullSafe(F.col(f"_of_{key}")) for key in keys]
    return numbered.join(counts, same, "left").select(
        *df.columns, (F.col("_at") + F.col("_base")).cast("long").alias(name)
    )


def strings(column: pa.Array) -> list[str]:
    """Python strings of an Arrow column, empty for NULL."""
    return ["" if x is None else x for x in column.to_pylist()]


_remembered: dict[str, object] = {}


def worker_memory(name: str, make: Callable[[], T]) -> T:
    """What a Python worker keeps from task to task under ``name``.

    Only the one asked for last is kept, so the stages of a job that share workers do not
    add up their memories.
    """
    if name not in _remembered:
        _remembered.clear()
        _remembered[name] = make()
    return _remembered[name]


def batches(rows: Iterable[dict], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Record batches of at most ``size`` rows."""
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all 64 bits (a bijection)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
