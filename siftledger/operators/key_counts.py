"""A stored count of rows per key that grows batch by batch, bucketed by the key.

The index is read with its buckets, so the join with a batch's counts shuffles the counts
alone: keys stored before stay where they are, however many there are. The same join says
which keys of the batch are repeated, within it or over all batches, and which were held by
a single row until now.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftledger.schemas import Relation
from siftledger.session import CODEC

BUCKETS = 64


def counts(rows: DataFrame, key: str) -> DataFrame:
    """key and n_added for every non-NULL key; counted per task before the shuffle."""
    return rows.groupBy(key).agg(F.count(key).alias("n_added")).where("n_added > 0")


def grown(index: DataFrame | None, added: DataFrame, key: str, batch: str) -> DataFrame:
    """The index after a batch: key, n_rows, n_added (by this batch) and first_batch.

    ``index``: from :func:`bucketed`; None before the first batch.
    """
    if index is None:
        return added.select(
            key, F.col("n_added").alias("n_rows"), "n_added", F.lit(batch).alias("first_batch")
        )
    before = index.select(key, F.col("n_rows").alias("_before"), "first_batch")
    new = F.coalesce("n_added", F.lit(0))
    return before.join(added, key, "full").select(
        key,
        (F.coalesce("_before", F.lit(0)) + new).alias("n_rows"),
        new.alias("n_added"),
        F.coalesce("first_batch", F.lit(batch)).alias("first_batch"),
    )


def repeated(index: DataFrame) -> DataFrame:
    """Keys of the last batch held by more than one row of all batches, with n_rows."""
    return index.where("n_added > 0 AND n_rows > 1")


def newly_repeated(index: DataFrame) -> DataFrame:
    """Keys that one earlier row held alone until the last batch brought them again."""
    return index.where("n_added > 0 AND n_rows - n_added = 1")


def write_bucketed(
    rows: DataFrame,
    relation: Relation,
    table: str,
    path: str,
    even: bool = False,
    buckets: int = BUCKETS,
) -> None:
    """Store an index as the external table ``table``, by bucket of its key.

    ``even``: the rows come out of a join with an index of as many buckets, so each task
    holds one bucket already and writes one file.
    """
    key = relation.primary_key
    rows = rows.select(*relation.schema.names)
    rows = rows if even else rows.repartition(buckets, key)
    stored = rows.write.bucketBy(buckets, key).sortBy(key).format("parquet").option("path", path)
    stored.option("compression", CODEC).saveAsTable(table)


def bucketed(
    spark: SparkSession, relation: Relation, table: str, path: str, buckets: int = BUCKETS
) -> DataFrame:
    """A stored index with its buckets, registered as ``table`` where the catalog lacks it."""
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in relation.schema)
        key = relation.primary_key
        spark.sql(
            f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({key}) "
            f"SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
    return spark.table(table)
