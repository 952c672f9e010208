"""Near words by composed acceptors, against comparing all pairs."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from siftledger.llm import edit_automata as ea


def cuts(word):
    return {word[:i] + word[i + 1 :] for i in range(len(word))}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and a in cuts(b)


def brute(count, factor=10):
    near = {w: [] for w in count}
    for a, b in combinations(count, 2):
        if is_near(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-count[o], o), default=None)
        form[w] = best if best is not None and count[best] >= factor * count[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted(
        (w, form[w] or "", root(w), n, len(near[w]), count[form[w]] if form[w] else -1)
        for w, n in count.items()
    )


def result(spark, count, **options):
    words = spark.createDataFrame(list(count.items()), "word string, n long")
    rows = ea.variants(words, **options).collect()
    return sorted(
        (r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], r["form_n"] or -1) for r in rows
    )


def drawn(size, letters="abé", seed=0, longest=9):
    draw = np.random.default_rng(seed)
    found = {}
    while len(found) < size:
        word = "".join(draw.choice(list(letters), draw.integers(1, longest + 1)))
        found[word] = int(10 ** draw.uniform(0, 5))
    return found


def test_acceptor_is_minimal_and_accepts_its_words():
    machine = ea.Acceptors()
    words = sorted({"tapes", "taxes", "tales", "rales", "rapes"})
    root = machine.add(words)
    assert sorted(machine.common(root, root)) == words
    # The end, before "s", before "es", one state each after "ta", "ra", "t" and "r", the start.
    assert len(machine.arcs) == 8
    before = len(machine.arcs)
    assert machine.add([]) is None and machine.add(["es"]) and len(machine.arcs) == before


@pytest.mark.parametrize("seed", range(6))
def test_every_partition_finds_its_pairs_once(seed):
    """The halves of every length, and any cutting of them, hold each near pair once."""
    words = drawn(250, "ab" if seed % 2 else "aéz", seed, 7)
    expected = sorted(tuple(sorted(p)) for p in combinations(words, 2) if is_near(*p))
    found = []
    width = (1, 2, 3, 4, 5, 100)[seed]
    for short in range(0, 8):
        for lo in range(0, short + 1, width):
            hi = min(lo + width, short + 1)
            groups = {}
            after = max(short - hi, 0)
            for w in words:
                if len(w) in (short, short + 1):
                    groups.setdefault(w[:lo] + "|" + w[len(w) - after :], []).append(w)
            for members in groups.values():
                found += [tuple(sorted(p)) for p in ea.near_pairs(members, short, lo, hi)]
    assert sorted(found) == expected


@pytest.mark.parametrize("most", [20_000, 40, 3])
def test_variants_against_brute_force(spark, most):
    """Also where every partition has to be halved down to one free place."""
    count = drawn(400, "abc", 1, 8)
    assert result(spark, count, most=most) == brute(count)


def test_hot_partition_is_halved(spark):
    """A third of all words share a long beginning: no partition stays over the limit."""
    draw = np.random.default_rng(2)
    count = {"x" * 12 + "".join(draw.choice(list("abcde"), 6)): 1 for _ in range(300)}
    count |= {w: 1 for w in drawn(500, "abcdefgh", 3, 10)}
    words = spark.createDataFrame(list(count.items()), "word string, n long")
    rows = ea.partitions(words, 25).collect()
    assert all(len(r["words"]) <= 25 or r["hi"] - r["lo"] == 1 for r in rows)
    hot = [r for r in rows if r["words"][0]["word"].startswith("xxx")]
    assert len(hot) > 20 and max(len(r["words"]) for r in hot) <= 25
    assert result(spark, count, most=25) == brute(count)


def test_forms_and_roots(spark):
    """A way over several forms, ties by code point, the factor exactly met and just missed."""
    count = {
        "colours": 1, "colour": 10, "color": 100, "colar": 1000, "colare": 99,
        "tiez": 10, "tiea": 100, "tieb": 100, "tie": 9, "alone": 7,
        "same": 9, "samé": 90, "sami": 89,
    }
    assert result(spark, count) == brute(count)
    rows = {r[0]: r for r in result(spark, count)}
    assert rows["colours"][1:3] == ("colour", "colar") and rows["tiez"][1] == "tiea"
    assert rows["same"][1] == "samé" and rows["alone"][1:] == ("", "alone", 7, 0, -1)


def test_awkward_vocabularies(spark):
    long = "ab" * 2000
    count = {"": 5, "a": 50, "b": 1, "ab": 3, long: 1, long[:-1]: 20, long[:1000] + "c" + long[1001:]: 300}
    assert result(spark, count) == brute(count)
    assert result(spark, {"only": 2}) == [("only", "", "only", 2, 0, -1)]
    empty = spark.createDataFrame([], "word string, n long")
    assert ea.variants(empty).collect() == []


def spelled(rows, least_letters=7, least_count=2):
    found = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{i}:{run}".encode()) if i is not None else 1
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if n >= least_count and len(w) >= least_letters}


def test_vocabulary_against_plain_python(spark, documents):
    draw = np.random.default_rng(4)
    words = ["Strasse", "straße_x", "ÉCOLEÉCOLE", "naïveté", "Variable", "variables", "İstanbulx", "x" * 500]
    rows = [(i, " ".join(draw.choice(words, 40)) + ". " * (i % 3)) for i in range(300)]
    rows += [(None, "Variable variables"), (1, None), (2, ""), (3, "Variable"), (3, "Variable")]
    found = {r["word"]: r["n"] for r in ea.vocabulary(documents(*rows)).collect()}
    assert found == spelled(rows)
    assert any(len(w) == 499 for w in found) and "ÉcoleÉcole" in found


def test_awkward_documents(spark, awkward):
    found = ea.variants(ea.vocabulary(awkward)).collect()
    assert {r["word"] for r in found} == set(spelled([(r["doc_id"], r["text"]) for r in awkward.collect()]))
    assert ea.variants(ea.vocabulary(awkward.limit(0))).collect() == []
