"""Rows marked by place: the same as a join with the keys, whatever files they lie in."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from siftledger.operators import places
from siftledger.operators.duplicates import mark_repeated, repeated_keys
from siftledger.session import materialise
from test_duplicates import brute_force, plan_of


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Two files of several blocks and a short one; every eleventh row has no key."""
    path = str(tmp_path_factory.mktemp("places") / "rows")
    key = F.when(F.col("id") % 11 != 0, F.col("id") % 50_000).alias("key")
    spark.range(0, 140_000, 1, 2).select("id", key).write.parquet(path)
    spark.range(140_000, 140_003).coalesce(1).select("id", key).write.mode("append").parquet(path)
    return spark.read.schema("id long, key long").parquet(path).select("id", "key")


# Both ends of words and blocks, a stretch, and keys that no row has.
WANTED = "id IN (1, 55, 56, 57, 32767, 32768, 32769, 49999) OR id BETWEEN 777 AND 900 OR id > 49990"


@pytest.mark.parametrize("max_blocks", [places.MAX_BLOCKS, 5, 0])
def test_rows_without_keys(spark, stored, max_blocks):
    keys = spark.range(51_000).where(WANTED).select(F.col("id").alias("key"))
    assert places.can_be_marked(stored, max_blocks) == (max_blocks > 7)
    found = places.without(stored, keys, "key", max_blocks)
    expected = stored.join(keys, "key", "left_anti").select("id", "key")
    assert found.columns == ["id", "key"] and found.count() == expected.count()
    assert found.exceptAll(expected).isEmpty() and expected.where("key IS NULL").count() > 12_000
    assert ("_words" in plan_of(found)) == (max_blocks > 7)  # joined with the keys only if they must be


@pytest.mark.parametrize("max_blocks", [places.MAX_BLOCKS, 0])
def test_rows_with_keys(spark, stored, max_blocks):
    keys = spark.range(51_000).where(WANTED).select(F.col("id").alias("key"))
    found = places.among(stored, keys, "key", max_blocks)
    expected = stored.join(keys, "key", "left_semi").select("id", "key")
    assert found.columns == ["id", "key"] and found.count() == expected.count() > 300
    assert found.exceptAll(expected).isEmpty()
    assert ("_words" in plan_of(found)) == (max_blocks > 0)


def test_no_rows_and_no_keys(spark, stored):
    none = spark.range(1).where("false").select(F.col("id").alias("key"))
    assert places.without(none, stored.select("key"), "key").count() == 0
    assert places.without(stored, none, "key").count() == 140_003


def test_repeated_keys_by_place(spark, tmp_path):
    """Hot keys, rows without a key, and light keys in several files; rows are not shuffled."""
    keys = [1] * 400 + [None] * 300 + [k for k in range(100, 150) for _ in range(2)] + [*range(1000, 1330)]
    rows = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "row int, key long")
    rows.repartition(5).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.schema("row int, key long").parquet(str(tmp_path / "rows"))
    repeated = materialise(repeated_keys(rows, "key"), "test-repeated")
    limits = {"max_broadcast_keys": 3, "min_hot_rows": 100}
    marked = mark_repeated(rows, "key", repeated, "again", **limits, by_place=True)
    assert marked.columns == ["row", "key", "again"] and marked.count() == len(keys)
    assert {r.row: r.again for r in marked.collect()} == brute_force(rows)
    assert "hashpartitioning" not in plan_of(marked) and "_words" in plan_of(marked)
    assert "_words" not in plan_of(mark_repeated(rows, "key", repeated, "again", **limits))
