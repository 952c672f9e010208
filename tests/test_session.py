"""Where intermediate results go."""

from __future__ import annotations

from pathlib import Path

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from siftledger.session import SETTINGS, materialise, scratch_dir, shuffles_sized_for


def fake_session(master, named=None):
    conf = {"spark.checkpoint.dir": named} if named else {}
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d), set=conf.__setitem__),
        sparkContext=SimpleNamespace(master=master),
    )


def test_the_named_folder_is_used():
    assert scratch_dir(fake_session("yarn", "hdfs:///shared")) == "hdfs:///shared"


def test_a_cluster_without_a_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(fake_session("yarn"))


def test_a_local_session_gets_its_own_folder():
    session = fake_session("local[2]")
    assert scratch_dir(session) == scratch_dir(session)


def test_materialised_rows_keep_pushdown(spark):
    stored = materialise(spark.range(10).selectExpr("id", "id * 2 AS twice"), "test")
    plan = stored.where("id > 7").select("twice")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,7)]" in plan
    assert stored.where("id > 7").count() == 2
    assert SETTINGS["spark.sql.session.timeZone"] == "UTC"


def test_shuffles_grow_with_the_scan(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with shuffles_sized_for(spark.range(0, 1000, 1, numPartitions=80)):
        assert spark.conf.get(key) == "20"
    with pytest.raises(ZeroDivisionError), shuffles_sized_for(spark.range(10)):
        assert spark.conf.get(key) == before  # never fewer than configured
        raise ZeroDivisionError
    assert spark.conf.get(key) == before


def test_released_steps_leave_no_files(spark, tmp_path):
    """Only what materialise has written goes; other sources of a step stay."""
    from siftledger.session import release

    spark.range(5).write.parquet(str(tmp_path / "source"))
    source = spark.read.parquet(str(tmp_path / "source"))
    stored, kept = materialise(source, "one"), materialise(source, "two")
    folder = Path(stored.inputFiles()[0].removeprefix("file://")).parent
    release(stored.where("id > 1"), source)
    assert not folder.exists()
    assert kept.count() == source.count() == 5


def shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(blocks.getAllFiles())
    return {f.getName() for f in files if f.getName().startswith("shuffle_")}


def test_shuffle_files_go_with_their_query(spark, tmp_path):
    """Those of a write, of a query and of one that is asked twice."""
    from siftledger.session import shuffles_removed

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = shuffle_files(spark), spark.conf.get(key)
    with pytest.raises(ZeroDivisionError), shuffles_removed(spark):
        spark.range(100).repartition(3, "id").write.parquet(str(tmp_path / "stored"))
        counts = spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()
        assert len(counts.collect()) == len(counts.collect()) == 7
        assert shuffle_files(spark) <= before
        raise ZeroDivisionError
    assert spark.conf.get(key) == setting


def test_a_codec_may_be_named(spark):
    stored = materialise(spark.range(5), "test", "zstd")
    assert all(".zstd." in f for f in stored.inputFiles()) and stored.count() == 5
