"""The stages against what the operators say on their own."""

from __future__ import annotations

from pathlib import Path

import pytest

import corpus_pipeline
from siftledger.llm import lsh_forest, templates
from siftledger.llm.common import table

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output rows of each stage, written between stages as a run does."""
    docs, found = table(spark, FOLDER, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, docs, FOLDER).write.parquet(out)
        found[name] = (docs, spark.read.parquet(out))
        docs = found[name][1]
    return found


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_columns_and_shrinking(stages):
    for name, (before, after) in list(stages.items())[:-1]:
        assert after.columns == before.columns
        assert set(ids(after)) <= set(ids(before)) and after.count() <= before.count()


def test_quality_keeps_good_labels(spark, stages):
    labels = {r["doc_id"]: r["quality"] for r in table(spark, FOLDER, "labels").collect()}
    kept = set(ids(stages["quality"][1]))
    good = [i for i, y in labels.items() if y == 1]
    assert sum(i in kept for i in good) >= 0.97 * len(good)
    assert sum(i in kept for i, y in labels.items() if y == 0) <= 0.1 * len(labels)


def test_line_runs_keep_what_is_unrepeated(stages):
    before, after = stages["line_runs"]
    texts = {r["doc_id"]: r["text"] for r in before.collect()}
    kept = [r for r in after.collect()]
    for r in kept:
        mine = r["text"].split("\n")
        assert set(mine) <= set(texts[r["doc_id"]].split("\n"))
    lines = [x for r in kept for x in r["text"].split("\n") if len(x.split()) >= 5]
    assert len(lines) == len(set(lines))


def test_one_of_each_near_duplicate(stages):
    before, after = stages["near_duplicates"]
    groups = lsh_forest.near_duplicates(before).collect()
    assert ids(after) == sorted(r["doc_id"] for r in groups if r["kept"])


def test_no_benchmark_item_is_left(spark, stages):
    before, after = stages["decontamination"]
    found = templates.leaked_items(before, table(spark, FOLDER, "benchmark")).collect()
    assert set(ids(before)) - set(ids(after)) == {r["doc_id"] for r in found}


def test_all_that_is_left_is_packed(stages):
    before, after = stages["packing"]
    assert set(ids(after)) == set(ids(before))
    used = {}
    for r in after.collect():
        used[r["sequence_id"]] = used.get(r["sequence_id"], 0) + r["length"]
    assert max(used.values()) <= 2048
