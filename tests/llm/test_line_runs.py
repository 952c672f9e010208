from __future__ import annotations

import random

import pytest

from siftledger.llm import line_runs


def brute(rows, least):
    """Kept text per row: every run of ``least`` words that comes earlier as well is cut.

    All runs are compared as texts, of every length, in order of doc_id, row and line.
    """
    docs = []
    for row, (doc_id, text) in enumerate(rows):
        lines = (text or "").split("\n")
        filled = [(i, x, len(x.strip(" ").replace(" ", "\0").split("\0"))) for i, x in enumerate(lines) if x.strip(" ")]
        docs.append(((doc_id is not None, doc_id or 0, row), text, lines, filled))
    seen, gone = {}, {d[0]: set() for d in docs}
    for key, _, _, filled in sorted(docs, key=lambda d: d[0]):
        for start in range(len(filled)):
            for end in range(start + 1, len(filled) + 1):
                run = filled[start:end]
                if sum(w for _, _, w in run) < least:
                    continue
                text = tuple(x for _, x, _ in run)
                if seen.setdefault(text, (key, start)) != (key, start):
                    gone[key].update(i for i, _, _ in run)
    found = []
    for key, text, lines, filled in docs:
        kept = "\n".join(x for i, x in enumerate(lines) if i not in gone[key])
        found.append((rows[key[2]][0], text if not gone[key] else kept, len(filled), len(gone[key])))
    return found


def result(docs, least):
    rows = line_runs.deduplicated(docs, least).collect()
    return sorted(map(str, ((r["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in rows)))


@pytest.mark.parametrize(("seed", "least"), [(1, 1), (2, 3), (3, 5), (4, 8), (5, 13)])
def test_against_brute_force(documents, seed, least):
    draw = random.Random(seed)
    lines = [" ".join(draw.choices("abc", k=draw.randint(1, 3))) for _ in range(6)] + [""]
    rows = [(i, "\n".join(draw.choices(lines, k=draw.randint(1, 9)))) for i in range(40)]
    assert result(documents(*rows), least) == sorted(map(str, brute(rows, least)))


def test_first_copy_stays_and_short_lines_recur(documents):
    passage = "one two three four\nfive six"
    rows = [(1, f"head\n{passage}\ntail"), (2, f"{passage}\nhead"), (3, "one two three four")]
    found = {r["doc_id"]: r["text"] for r in line_runs.deduplicated(documents(*rows), 5).collect()}
    assert found == {1: rows[0][1], 2: "head", 3: "one two three four"}


def test_awkward_rows(awkward, documents):
    docs = awkward.withColumnRenamed("source", "n_removed").withColumnRenamed("lang", "_row")
    found = line_runs.deduplicated(docs)
    assert found.columns[: len(docs.columns)] == docs.columns
    texts = sorted((r["doc_id"] or -1, r["text"] or "", r["text"] is None) for r in found.collect())
    same = "Twice the very same row of plain words."
    expected = [(r["doc_id"] or -1, r["text"] or "", r["text"] is None) for r in docs.collect()]
    expected = sorted([x for x in expected if x[1] != same] + [(5, same, False), (5, "", False), (6, "", False)])
    assert texts == expected
    assert line_runs.deduplicated(documents()).count() == 0
