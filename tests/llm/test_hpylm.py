from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from siftledger.llm import hpylm

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), None]


def expected(rows):
    out = [i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows]
    counts = Counter(w for (_, t), o in zip(rows, out) if not o for w in words(t))
    n, v = sum(counts.values()), len(counts)
    found = []
    for (i, t), o in zip(rows, out):
        w = words(t)
        base = sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        found.append((str(i), o, len(w), sum(counts[x] > 0 for x in w), n, round(base, 6)))
    return sorted(found)


def result(rows):
    return sorted(
        (
            str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"],
            round(r["base_score"], 6),
        )
        for r in rows
    )


def corpus(n=160):
    draw = random.Random(7)
    follow = {f"w{i}": [f"w{draw.randint(0, 59)}" for _ in range(3)] for i in range(60)}
    rows = []
    for i in range(n):
        word, text = f"w{draw.randint(0, 59)}", []
        for _ in range(draw.randint(5, 60)):
            text.append(word.upper() if draw.random() < 0.1 else word)
            word = draw.choice(follow[word]) if draw.random() < 0.9 else f"n{draw.randint(0, 99999)}"
            follow.setdefault(word, [f"w{draw.randint(0, 59)}"])
        rows.append((i, " ".join(text)))
    return rows


def test_counts_base_and_gain(documents):
    rows = corpus()
    found = hpylm.scores(documents(*rows)).collect()
    assert result(found) == expected(rows)
    held = [r for r in found if r["held_out"]]
    assert held and sum(r["score"] for r in held) > 0.7 * sum(r["base_score"] for r in held)


def test_chunks_do_not_change_counts(documents, monkeypatch):
    """Texts cut at any place, and many chunks."""
    monkeypatch.setattr(hpylm, "CHUNK", 37)
    rows = corpus(40)
    assert result(hpylm.scores(documents(*rows)).collect()) == expected(rows)


def test_probabilities_of_all_words_add_up(documents):
    """One-word texts after the same start: P(w|end) over known words and the unknown type."""
    train = [(i, t) for i, t in enumerate(["a b", "a c a", "b", "a b c", "c", "a a"] * 3, start=1)]
    train = [(i, t) for i, t in train if zlib.crc32(str(i).encode()) % 10]
    held = [i for i in range(1000, 3000) if zlib.crc32(str(i).encode()) % 10 == 0]
    # log P("w") + log P(end|w); "w w" holds P(w|w) too, so texts of one word and none suffice.
    probes = ["", "a", "b", "c", "zzz"]
    rows = train + list(zip(held, probes)) + [(held[10], "a a"), (held[11], "a b"), (held[12], "a c"), (held[13], "a zzz")]
    p = {r["doc_id"]: 10 ** r["score"] for r in hpylm.scores(documents(*rows)).collect()}
    score = {t: p[i] for i, t in rows if i in held}
    # P(x|a) = P("a x") / (P("a") / P(end|a)) / P(end|x); end after x from one more word.
    assert 0 < score[""] < 1 and all(0 < x < 1 for x in score.values())
    assert score[""] + sum(score[w] for w in ("a", "b", "c", "zzz")) < 1


def test_seating_against_simulation():
    """Mean tables of n customers by the tabulated conditional and by drawing."""
    seating, draw = hpylm.Seating(0.6), np.random.default_rng(3)
    n, a = np.full(40_000, 6), np.full(40_000, 1.0)
    tables = seating.drawn(n, a, draw)
    assert tables.min() >= 1 and tables.max() <= 6
    assert tables.mean() == pytest.approx(seating.expected(n[:1], a[:1])[0], rel=0.01)
    # p(t) ~ S(n, t) a^t by enumeration for n = 3: S = (1-d)(2-d), 3(1-d), 1.
    d = 0.6
    weight = np.array([(1 - d) * (2 - d), 3 * (1 - d), 1.0])
    assert seating.expected(np.array([3]), np.array([1.0]))[0] == pytest.approx(
        (weight * [1, 2, 3]).sum() / weight.sum(), rel=1e-6
    )
    many = seating.expected(np.array([10**7]), np.array([0.5]))[0]
    assert 1 < many < 10**5


def test_awkward_rows(awkward, documents):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    found = hpylm.scores(awkward).collect()
    assert result(found) == expected(rows)
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in found)
    assert hpylm.scores(documents()).count() == 0


def test_batches_of_messages_are_bounded():
    """However many messages fit a batch by number, it holds a few MB."""
    megabyte = bytes(1 << 20)
    sent = list(hpylm._sent(((1, "state", i, megabyte) for i in range(20)), 64))
    assert sum(b.num_rows for b in sent) == 20
    assert max(b.nbytes for b in sent) < 6 << 20


def test_steps_read_small_batches_and_store_no_chunks(spark, documents, monkeypatch):
    key, seen = "spark.sql.execution.arrow.maxBytesPerBatch", []
    store, before = hpylm.materialise, spark.conf.get(key)

    def stored(df, label):
        seen.append((label, spark.conf.get(key)))
        return store(df, label)

    monkeypatch.setattr(hpylm, "materialise", stored)
    rows = corpus(40)
    assert result(hpylm.scores(documents(*rows)).collect()) == expected(rows)
    assert "chunks" not in {label for label, _ in seen}
    assert {size for label, size in seen if label in ("counts", "seats", "scores")} == {
        str(hpylm.BATCH_BYTES)
    }
    assert spark.conf.get(key) == before


def test_distinct_keys_as_numpy_gives_them():
    keys = np.random.default_rng(1).integers(0, 2**64, 500, np.uint64)[[*range(500), *range(300)]]
    for some in (keys, keys[:1], keys[:0]):
        for mine, numpys in zip(hpylm._distinct(some), np.unique(some, return_inverse=True)):
            assert (mine == numpys).all() and len(mine) == len(numpys)


def test_values_that_nobody_reads_are_not_sent():
    held = {
        "places": {0: hpylm._pack([5], [np.array([0, 1])], np.array([2, 3]))},
        "tables": {5: hpylm._pack(np.array([1, 2]), np.array([3, 4]), np.array([0.5, 1.5]))},
    }

    def sent(*reads):
        messages = list(hpylm._parent(3, 2, 0.5, 2, *reads)(-1, held))
        return hpylm._values({-1: next(m[3] for m in messages if m[1] == "values")})

    opened, expected, seated = sent(True, True)
    assert opened.tolist() == [3, 4] and expected.tolist() == [0.5, 1.5]
    first, none, same = sent(True, False)
    assert none is None and first.tolist() == [3, 4] and same.tolist() == seated.tolist()
    none, again, same = sent(False, True)
    assert none is None and again.tolist() == [0.5, 1.5] and same.tolist() == seated.tolist()
