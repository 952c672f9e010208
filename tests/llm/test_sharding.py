from __future__ import annotations

import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from siftledger.llm import sharding


def check_slots(rows, shards=8):
    slots = defaultdict(list)
    for r in rows:
        assert 0 <= r["shard"] < shards
        slots[r["shard"]].append(r["slot"])
    for found in slots.values():
        assert sorted(found) == list(range(len(found)))


def test_awkward_rows(awkward):
    rows = sharding.sharded(awkward).collect()
    check_slots(rows)
    expected = sorted(
        (len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode()))
        for r in awkward.collect()
    )
    assert sorted((r["size"], r["text_crc32"]) for r in rows) == expected


def test_empty_table(documents):
    assert sharding.sharded(documents()).count() == 0


def test_near_equal_bytes_and_whole_groups(documents):
    draw = random.Random(4)
    rows = [(i, f"{i} " + "w" * draw.randint(1, 400)) for i in range(3000)]
    rows += [(5000 + i, f"copy {i % 40} of a text") for i in range(400)]
    found = sharding.sharded(documents(*rows)).collect()
    check_slots(found)
    sums, of = defaultdict(int), defaultdict(set)
    for r in found:
        sums[r["shard"]] += r["size"]
        of[r["text_crc32"], r["size"]].add(r["shard"])
    mean = sum(sums.values()) / 8
    assert max(abs(s - mean) for s in sums.values()) <= 0.021 * mean
    assert sum(len(s) > 1 for s in of.values()) == 0


def test_a_text_with_most_rows_is_split(documents):
    rows = [(i, "the same text again and again") for i in range(2000)]
    rows += [(3000 + i, f"other text {i}") for i in range(500)]
    found = sharding.sharded(documents(*rows))
    check_slots(found.collect())
    sums = [r[0] for r in found.groupBy("shard").agg(F.sum("size")).select("sum(size)").collect()]
    assert len(sums) == 8 and max(sums) <= 1.03 * min(sums)


def test_splitters_by_exact_counts(spark, documents):
    """Against sorting all keys: bytes before each splitter are within tolerance."""
    draw = random.Random(9)
    rows = [(draw.getrandbits(63), draw.getrandbits(63), draw.randint(1, 50)) for _ in range(4000)]
    df = spark.createDataFrame(rows, "k long, t long, size long").cache()
    total = sum(r[2] for r in rows)
    begins = sharding.splitters(df, "size", "k", "t", shards=5, tolerance=0.01, probes=16)
    for i, begin in enumerate(begins, start=1):
        before = sum(s for k, t, s in rows if (k, t) < begin)
        assert abs(before - total * i / 5) <= 0.01 * total / 5


def test_slots_follow_the_key_order(documents):
    rows = [(i, f"text {i % 700}") for i in range(1500)]
    found = sharding.sharded(documents(*rows)).withColumn("k", F.xxhash64("text_crc32"))
    by_shard = defaultdict(list)
    for r in found.orderBy("shard", "slot").collect():
        by_shard[r["shard"]].append(r["text_crc32"])
    for texts in by_shard.values():
        changes = sum(a != b for a, b in zip(texts, texts[1:]))
        assert changes == len(set(texts)) - 1  # equal texts are neighbours
