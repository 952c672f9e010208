"""Distinct counts by bitmaps against sets."""

from __future__ import annotations

import random

from siftledger.operators.bitmaps import distinct_in_bitmaps, id_bitmaps


def test_any_union_of_groups(spark):
    draw = random.Random(3)
    edges = [0, 1, -1, 32767, 32768, 32769, -32768, 2**40, 2**63 - 1, -(2**62), None]
    rows = [(draw.choice("abcd"), draw.randint(0, 3), draw.choice(edges + list(range(200)))) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, h int, id long")
    stored = id_bitmaps(df, ["g", "h"], "id")
    for groups in (["g", "h"], ["g"], ["h"], []):
        found = {tuple(r)[:-1]: r["n"] for r in distinct_in_bitmaps(stored, groups, "n").collect()}
        at = ["gh".index(c) for c in groups]
        expected = {}
        for row in rows:
            if row[2] is not None:
                expected.setdefault(tuple(row[i] for i in at), set()).add(row[2])
        assert found == {k: len(v) for k, v in expected.items()}
    some = stored.where("g IN ('a', 'c') AND h > 0")
    assert distinct_in_bitmaps(some, [], "n").first()["n"] == len(
        {r[2] for r in rows if r[0] in "ac" and r[1] > 0 and r[2] is not None}
    )


def test_no_rows(spark):
    df = spark.createDataFrame([("a", None)], "g string, id long")
    assert id_bitmaps(df, ["g"], "id").count() == 0
    assert id_bitmaps(df.limit(0), ["g"], "id").count() == 0


def test_blocks_are_built_before_the_shuffle(spark):
    plan = id_bitmaps(spark.range(10).selectExpr("1 AS g", "id"), ["g"], "id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.index("partial_bitmap_construct_agg") > text.index("Exchange hashpartitioning")
