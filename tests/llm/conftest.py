"""Small tables with the awkward cases that every operator has to bear."""

from __future__ import annotations

import pytest

WIDE = "doc_id long, text string, lang string, source string, n_chars long, score double, row string"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text), with columns whose names operators use themselves."""

    def build(*rows: tuple):
        full = [(i, t, "en", "s", len(t or ""), 0.0, "r") for i, t in rows]
        return spark.createDataFrame(full, WIDE)

    return build


@pytest.fixture(scope="session")
def awkward(documents):
    """NULL and empty texts, blanks, NULL ids, ties, repeated rows, a very long text."""
    long = " ".join(f"word{i % 977} and{i % 13}" for i in range(20_000))
    return documents(
        (1, "Some words here, and a few more of them.\nA second line with six words."),
        (2, None),
        (3, ""),
        (4, " \n\t "),
        (None, "no id but text of a few words"),
        (None, None),
        (5, "Twice the very same row of plain words."),
        (5, "Twice the very same row of plain words."),
        (6, "Twice the very same row of plain words."),
        (7, long),
        (8, "x" * 30_000),
    )
