"""Session settings, and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Every timestamp is an instant shown in UTC. The local-map threshold lets a sort-merge
# join become a hash join at run time, once its measured build partitions fit.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # Staged rows are written into two folders, by verdict. Two open writers per task do
    # that without sorting every task's rows first.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    # Plans are built from many small column calls; recording the Python line of each
    # takes longer than planning.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configured(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Add the settings the marts rely on to a session builder."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


# Codec of stored tables: about two thirds of the bytes of Spark's default.
CODEC = "zstd"

# Key shuffles carry a fraction of the bytes of the rows they come from.
SPLITS_PER_SHUFFLE_PARTITION = 4


@contextmanager
def shuffles_sized_for(scan: DataFrame) -> Iterator[None]:
    """Within the block, shuffles get at least a partition per four splits of ``scan``.

    A fixed number of partitions outgrows executor memory as the feed grows. Adaptive
    execution merges the partitions that turn out small, so too many do no harm.
    """
    key, conf = "spark.sql.shuffle.partitions", scan.sparkSession.conf
    before = int(conf.get(key))
    conf.set(key, max(before, scan.rdd.getNumPartitions() // SPLITS_PER_SHUFFLE_PARTITION))
    try:
        yield
    finally:
        conf.set(key, before)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within the block, the shuffle files of every query go when it ends.

    Spark deletes them when the driver's JVM collects the plan they belong to. A long job with
    little garbage on the driver would keep those of all its steps on disk until its end.
    """
    key, conf = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", spark.conf
    before = conf.get(key, "false")
    conf.set(key, "true")
    try:
        yield
    finally:
        conf.set(key, before)


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder: on a cluster
    other executors could not read it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    named = tempfile.mkdtemp(prefix="siftledger-")
    spark.conf.set("spark.checkpoint.dir", named)
    return named


def materialise(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Unlike a cached block the files outlive lost executors, and readers keep column
    pruning and filter pushdown. ``codec``: None leaves it to the session.
    """
    spark = df.sparkSession
    application = spark.sparkContext.applicationId
    target = f"{scratch_dir(spark)}/{application}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(target, compression=codec)
    return spark.read.schema(df.schema).parquet(target)


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete files or folders, wherever Spark can write; those that are gone do not matter."""
    context = spark.sparkContext
    hadoop = context._jsc.hadoopConfiguration()
    for name in paths:
        path = context._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(hadoop).delete(path, True)


def release(*stored: DataFrame) -> None:
    """Remove the files of materialised steps, once all that reads them is stored.

    Spark deletes shuffle files when the driver's JVM collects the plans they belong to. A
    driver with little garbage would leave those of every step of a long job on the
    executors' disks, so it is asked to collect.
    """
    spark = stored[0].sparkSession
    own = f"/{spark.sparkContext.applicationId}/"
    folders = {path.rsplit("/", 1)[0] for df in stored for path in df.inputFiles()}
    remove(spark, *(folder for folder in folders if own in folder))
    spark.sparkContext._jvm.System.gc()
