"""Exact searches over whole-number vectors, against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest

from siftledger.llm import integer_vectors as iv
from siftledger.llm import maxscore, threshold

LONG = 2**63 - 1
INF, NAN = float("inf"), float("nan")


def whole(v):
    """Components in whole numbers, or None for a vector that takes no part."""
    if v is None or any(x is None or not math.isfinite(x) for x in v):
        return None
    scaled = [x * 256 for x in v]
    return [max(min(math.floor(x), LONG), -LONG - 1) if math.isfinite(x) else (LONG if x > 0 else -LONG - 1) for x in scaled]


def inner(a, b):
    return max(min(sum(x * y for x, y in zip(a, b)), LONG), -LONG - 1)


def brute_top(rows, k, every):
    used = {(i, tuple(w)) for i, v in rows if i is not None and (w := whole(v)) is not None}
    found = []
    for q, v in used:
        if q % every == 0:
            near = sorted((-inner(v, w), i) for i, w in used if i != q and len(w) == len(v))
            found += [(q, r, i, -s) for r, (s, i) in enumerate(near[:k], 1)]
    return sorted(found)


def top(df, every, k, **options):
    rows = maxscore.top(df, f"vec_id % {every} = 0", k, **options).collect()
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in rows)


def brute_negatives(rows, every, positives=5, negatives=10):
    used = {
        (i, tuple(w), l)
        for i, v, l in rows
        if i is not None and l is not None and (w := whole(v)) is not None
    }
    found = []
    for a, v, label in used:
        if a % every:
            continue
        alike = sorted((-inner(v, w), i) for i, w, l in used if l == label and i != a and len(w) == len(v))
        for s, p in alike[:positives]:
            others = sorted(
                (-t, i)
                for i, w, l in used
                if l != label and len(w) == len(v)
                and 30 * -s <= 100 * (t := inner(v, w)) <= 90 * -s
            )
            found += [(a, p, r, i, -s, -t) for r, (t, i) in enumerate(others[:negatives], 1)]
    return sorted(found)


def negatives(df, every, **options):
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    mined = threshold.hard_negatives(df, f"vec_id % {every} = 0", **options)
    return sorted(tuple(r[n] for n in names) for r in mined.collect())


def drawn(kind, count=700, dim=12, seed=3):
    """Random vectors of several natures; ids in no order."""
    draw = np.random.default_rng(seed)
    if kind == "normal":
        v = draw.normal(0, 0.1, (count, dim))
    elif kind == "clusters":
        v = draw.normal(0, 1, (7, dim))[draw.integers(0, 7, count)] + draw.normal(0, 0.02, (count, dim))
    elif kind == "ties":
        v = draw.integers(-1, 2, (count, dim)) / 256
    elif kind == "sparse":
        v = draw.normal(0, 1, (count, dim)) * (draw.random((count, dim)) < 0.15)
    else:
        v = -np.abs(draw.normal(0, 1, (count, dim)))
    ids = draw.permutation(count * 2)[:count]
    return [(int(i), x.round(4).tolist(), int(draw.integers(0, 4))) for i, x in zip(ids, v)]


@pytest.mark.parametrize("kind", ["normal", "clusters", "ties", "sparse", "negative"])
def test_against_brute_force(spark, kind):
    rows = drawn(kind)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    few = dict(shard_nodes=200, block_queries=7)
    assert top(df, 9, 5, **few) == brute_top([r[:2] for r in rows], 5, 9)
    expected = brute_negatives(rows, 9)
    assert negatives(df, 9, **few) == expected
    assert expected or kind == "ties"


def test_searches_read_less_than_everything():
    """Where few nodes are near, most are never scored."""
    draw = np.random.default_rng(5)
    v = draw.integers(0, 40, (4000, 8)) * (draw.random((4000, 8)) < 0.2)
    v[:30] = draw.integers(200, 256, (30, 8))
    query = np.full(8, 7.0)
    shard = maxscore.Shard(v.astype(float), *maxscore.postings(v))
    rows = maxscore.competitive(shard, query, 5)
    best = np.sort(v @ query)[-5:]
    assert len(rows) < 40 and set(np.flatnonzero(v @ query >= best[0])) <= set(rows)
    order = np.argsort(v, axis=0, kind="stable").T

    class Counted(np.ndarray):
        read = 0

        def __getitem__(self, key):
            if isinstance(key, np.ndarray):
                Counted.read += len(key)
            return super().__getitem__(key)

    ((rows, scores),) = threshold.sorted_access(
        v.astype(float).view(Counted), order, np.ones(4000, bool), query, [(None, None)], 5
    )
    assert sorted(np.asarray(scores)) == sorted(best) and 0 < Counted.read < 400


def test_windows_round_inwards():
    assert threshold.window(7) == (3, 6) and threshold.window(10) == (3, 9)
    assert threshold.window(0) == (0, 0) and threshold.window(-7) == (-2, -7)


def test_one_vector_in_a_third_of_all_rows(spark):
    rows = drawn("normal", 200)
    rows += [(10_000 + i, rows[0][1], i % 3) for i in range(100)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert top(df, 5, 5) == brute_top([r[:2] for r in rows], 5, 5)
    assert negatives(df, 5) == brute_negatives(rows, 5)


AWKWARD = [
    (0, [1.0, 2.0], 1), (1, [2.0, 1.0], 1), (2, None, 1), (3, [], 1), (4, [0.0, 0.0], 2),
    (5, [None, 1.0], 1), (10, [INF, 1.0], 2), (15, [NAN, 1.0], 1), (20, [1.0, 2.0], 2),
    (None, [1.0, 1.0], 1), (25, [1.0, 2.0, 3.0], 1), (20, [1.0, 2.0], 2), (6, [-1.0, 0.5], None),
    (7, [1.0, 1.5], 2), (8, [0.5, 0.5], 3), (30, [], 1), (35, [0.25, 0.75], 1),
    (35, [0.75, 0.25], 1), (40, [1e300, -1e300], 2), (41, [1e17, 1e17], 1), (42, [1e9, 3e8], 3),
]


def test_awkward_rows(spark):
    """NULLs, no components, zeros, repeated rows and ids, numbers beyond long, other columns."""
    full = [(*r, "x", 0.5) for r in AWKWARD]
    df = spark.createDataFrame(
        full, "vec_id long, embedding array<double>, label int, node string, score double"
    )
    assert top(df, 5, 20) == brute_top([r[:2] for r in AWKWARD], 20, 5)
    assert negatives(df, 5) == brute_negatives(AWKWARD, 5)
    assert top(df.limit(0), 5, 20) == [] and negatives(df.limit(0), 5) == []


def test_labels_move_on(spark):
    df = spark.createDataFrame([(7, 9), (14, 3), (8, 9), (21, None)], "vec_id long, label int")
    assert [r["label"] for r in threshold.labelled(df).collect()] == [0, 4, 9, None]


def test_shards_and_blocks_hold_every_node_once(spark):
    rows = drawn("normal", 300)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    stored = iv.stored_nodes(iv.nodes(iv.rows(df), ["v"], 3), iv.rows(df).where("vec_id % 9 = 0"), ["v"])
    shards, blocks = iv.dealt(stored, ["v"], "asked", 100, 10)
    assert shards.count() == stored.select("node").distinct().count() == 300
    n_shards = shards.select("shard").distinct().count()
    assert n_shards == 3 and blocks.count() == n_shards * stored.where("asked").count()
