from __future__ import annotations

import random
import re

import pytest

from siftledger.llm import graph, lsh_forest

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return frozenset()
    n = min(5, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def brute(rows, percent=85):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    found = []
    for i, (doc_id, _) in enumerate(rows):
        component = least.get(root(i)) if sets[i] else doc_id
        found.append((doc_id, len(sets[i]), component, doc_id is not None and doc_id == component))
    return sorted(map(str, found))


def copies(draw, n, words=120, edits=3):
    """Chains of copies: each copies an earlier one with a few words changed."""
    base = [f"v{draw.randint(0, 400)}" for _ in range(words)]
    texts = [base]
    for _ in range(n - 1):
        text = list(draw.choice(texts))
        for _ in range(draw.randint(0, edits)):
            text[draw.randrange(len(text))] = f"e{draw.randint(0, 9999)}"
        texts.append(text)
    return [" ".join(t) for t in texts]


def test_shingles_are_the_sets():
    for text in ("", " ", "a", "a b", "A b c d", "a B c d e", "a b\tc\nd\x0be f a b c d e f", "é É x y z w"):
        assert len(lsh_forest.shingles(text)) == len(shingle_set(text))
    assert list(lsh_forest.shingles("A b")) == list(lsh_forest.shingles("a\n B"))


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(documents, seed, monkeypatch):
    draw = random.Random(seed)
    texts = [t for _ in range(6) for t in copies(draw, draw.randint(2, 25))]
    texts += [" ".join(f"u{draw.randint(0, 9999)}" for _ in range(60)) for _ in range(40)]
    texts += ["a b", "A  b", "a b c", "a b c d e", "", None]
    draw.shuffle(texts)
    rows = list(enumerate(texts, start=10))
    if seed == 2:  # crowded regions go to the greater depths
        monkeypatch.setattr(lsh_forest, "CROWDED", 3)
    found = lsh_forest.near_duplicates(documents(*rows)).collect()
    assert sorted(str(tuple(r)) for r in found) == brute(rows)


def test_awkward_rows(awkward, documents):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    found = lsh_forest.near_duplicates(awkward).collect()
    assert sorted(str(tuple(r)) for r in found) == brute(rows)
    assert lsh_forest.near_duplicates(documents()).count() == 0


def test_one_of_each(awkward):
    docs = awkward.withColumnRenamed("row", "_text_hash")
    left = lsh_forest.one_of_each(docs)
    assert left.columns == docs.columns
    kept = sorted((r["doc_id"] or -1) for r in left.collect())
    assert kept == [-1, -1, 1, 2, 3, 4, 5, 7, 8]


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    draw = random.Random(seed)
    edges = [(draw.randint(0, 60), draw.randint(0, 60)) for _ in range(45)]
    edges += [(100 + i, 101 + i) for i in range(40)] + [(500, 500 + i) for i in range(1, 30)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = sorted((root(u), root(v)))
        parent[b] = a
    linked = {x for u, v in edges if u != v for x in (u, v)}
    found = graph.components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {(r["node"], r["root"]) for r in found} == {(x, root(x)) for x in linked}
    assert len(found) == len(linked)


def changed(words, *places):
    words = list(words)
    for i in places:
        words[i] = f"{words[i]}x{i}"
    return words


def test_crowded_regions_lose_no_link(documents, monkeypatch):
    """Two groups of close copies, linked by one pair of similarity 0.858 alone."""
    draw = random.Random(5)
    texts = []
    for family in range(60):
        a = [f"f{family}w{draw.randint(0, 99999)}" for _ in range(200)]
        b = changed(a, 30, 90, 150)
        for words in (a, b):
            texts += [words] + [changed(words, i) for i in draw.sample(range(40, 80), 4)]
    rows = list(enumerate((" ".join(x) for x in texts), start=1))
    monkeypatch.setattr(lsh_forest, "CROWDED", 2)
    found = lsh_forest.near_duplicates(documents(*rows)).collect()
    assert sorted(str(tuple(r)) for r in found) == brute(rows)


def test_parts_are_bounded_and_hold_every_pair(spark):
    """A region of one large component and many others: each pair is compared once."""
    roots = [0] * 300 + [1] * 40 + list(range(1000, 1060))
    rows = [(0, i, r) for i, r in enumerate(roots)] + [(1, i, 7) for i in range(50)]
    members = spark.createDataFrame(rows, "g long, node long, root long")
    parts = {}
    for r in lsh_forest.paired(members, ["g"], 20).collect():
        parts.setdefault((r["g"], r["part"]), []).append(r)
    assert {g for g, _ in parts} == {0}
    assert max(map(len, parts.values())) <= 4 * 20
    seen = [
        tuple(sorted((a["node"], b["node"])))
        for held in parts.values()
        for a in held
        for b in held
        if a["asks"] and b["member"] and a["root"] != b["root"] and (not b["rest"] or b["node"] > a["node"])
    ]
    wanted = {(i, j) for j in range(len(roots)) for i in range(j) if roots[i] != roots[j]}
    assert len(seen) == len(set(seen)) and set(seen) == wanted


def test_limits_follow_the_least_similarity():
    assert lsh_forest.limits(85) == (85, 16, 64, 42)
    assert lsh_forest.limits(80).values == 4 * lsh_forest.limits(80).trees == 88
    for percent in (60, 80, 95, 100):
        assert (1 - (percent / 100) ** 4) ** lsh_forest.limits(percent).trees <= 1e-5
    with pytest.raises(ValueError):
        lsh_forest.limits(0)


def test_pairs_between_80_and_85_percent(documents):
    draw = random.Random(6)
    texts = []
    for _ in range(40):
        a = [f"w{draw.randint(0, 9999)}" for _ in range(200)]
        texts += [a, changed(a, 20, 60, 100, 150)]
    docs = documents(*(rows := list(enumerate((" ".join(x) for x in texts), start=1))))
    assert lsh_forest.one_of_each(docs).count() == 80
    assert lsh_forest.one_of_each(docs, 80).count() == 40
    found = lsh_forest.near_duplicates(docs, 80).collect()
    assert sorted(str(tuple(r)) for r in found) == brute(rows, 80)
