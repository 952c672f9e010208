from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from siftledger.llm import mil

GOOD = "river stone garden window morning letter quiet table summer bread walk evening".split()


def good(draw, n=150):
    return " ".join(draw.choice(GOOD) for _ in range(n)) + "."


def bad(draw, n=150):
    """Good passages with one of junk among them: only some passages tell."""
    words = good(draw, n).split()
    at = draw.randrange(0, n - 70)
    words[at : at + 70] = [w.upper() + "!!" for w in words[at : at + 70]]
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(5)
    return [(i, bad(draw) if i % 4 == 0 else good(draw), int(i % 4 != 0)) for i in range(600)]


def test_held_out_accuracy(spark, documents, corpus):
    docs = documents(*[(i, t) for i, t, _ in corpus])
    labels = spark.createDataFrame([(i, y, 0) for i, _, y in corpus], "doc_id long, quality int, toxic int")
    rows = {r["doc_id"]: r for r in mil.scored(docs, labels).collect()}
    assert set(rows) == {i for i, _, _ in corpus}
    right = 0
    for i, _, y in corpus:
        out = zlib.crc32(str(i).encode()) % 3 == 1
        assert rows[i]["held_out"] == out and 0 <= rows[i]["score"] <= 1
        assert rows[i]["predicted"] == int(rows[i]["score"] >= 0.5)
        right += out and rows[i]["predicted"] == y
    assert right >= 0.95 * sum(r["held_out"] for r in rows.values())


def test_gradients():
    draw = np.random.default_rng(0)
    x, starts, y = draw.normal(size=(7, mil.FEATURES)), np.array([0, 2, 3]), np.array([1.0, 0, 1])
    weights = [w + 0.01 for w in mil._start(3)]

    def loss():
        p = mil._forward(weights, x, starts)[-1]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    for w, slope in zip(weights, mil._gradients(weights, x, starts, y)):
        at = tuple(0 for _ in w.shape)
        before = w[at]
        w[at] = before + 1e-5
        up = loss()
        w[at] = before - 1e-5
        down = loss()
        w[at] = before
        assert slope[at] == pytest.approx((up - down) / 2e-5, abs=1e-7)


def test_attention_finds_the_passages(corpus):
    encode = mil.Encoder()
    model = mil.fit([encode(t) for _, t, _ in corpus[:300]], np.array([float(y) for *_, y in corpus[:300]]))
    x = encode(corpus[0][1])
    weight = mil._forward(model.weights, x, np.array([0]))[3]
    assert weight.sum() == pytest.approx(1)


def test_awkward_rows(spark, awkward, documents):
    nothing = spark.createDataFrame([(1, None), (None, 1), (2, 7), (5, 1), (5, 0)], "doc_id long, quality int")
    found = mil.scored(awkward, nothing)
    assert found.count() == awkward.count()
    scores = [r["score"] for r in found.collect()]
    assert all(0 <= s <= 1 for s in scores)
    assert mil.scored(documents(), nothing).count() == 0
    assert mil.scored(awkward, nothing.limit(0)).count() == awkward.count()
