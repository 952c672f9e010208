from __future__ import annotations

import numpy as np
import pytest

from siftledger.llm import hnsw


def brute(rows, k, every=5):
    found = {}
    usable = {
        i: np.array(v, float)
        for i, v in rows
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    }
    for q, v in usable.items():
        if q % every == 0:
            near = [(-float(v @ w), i) for i, w in usable.items() if i != q and len(w) == len(v)]
            found[q] = [(i, -s) for s, i in sorted(near)[:k]]
    return found


def result(df, k, **options):
    rows = hnsw.nearest(df, "vec_id % 5 = 0", k, **options).orderBy("query_id", "rank").collect()
    found = {}
    for r in rows:
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(found[r["query_id"]])
    return found


def test_recall_over_shards(spark):
    draw = np.random.default_rng(1)
    rows = [(i, draw.normal(size=24).round(3).tolist()) for i in range(1500)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    exact = brute(rows, 10)
    found = result(df, 10, shard_nodes=400, block_queries=70)
    assert set(found) == set(exact)
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in exact[q]}) for q in exact)
    assert hits >= 0.95 * 10 * len(exact)
    vectors = dict(rows)
    for q, near in found.items():
        assert near == sorted(near, key=lambda x: (-x[1], x[0])) and len(near) == 10
        for i, score in near:
            assert score == pytest.approx(float(np.dot(vectors[q], vectors[i])), rel=1e-12)


def test_copies_and_ties_are_exact(spark):
    rows = [(i, [1.0, 0.0]) for i in range(0, 40)] + [(i, [0.0, 1.0]) for i in range(40, 60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert result(df, 6) == brute(rows, 6)


def test_awkward_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (0, [1.0, 2.0]), (1, [2.0, 1.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [None, 1.0]),
        (10, [inf, 1.0]), (15, [nan, 1.0]), (20, [1.0, 2.0]), (None, [1.0, 1.0]), (25, [1.0, 2.0, 3.0]),
        (20, [1.0, 2.0]), (6, [-1.0, 0.5]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    expected = {q: near for q, near in brute(rows, 20).items() if near}
    assert result(df, 20) == expected
    assert result(df.limit(0), 20) == {}
