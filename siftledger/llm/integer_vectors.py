"""Vectors in whole numbers, their distinct nodes, shards of nodes and exact scores.

Rows with one vector (and label) are one node that keeps its smallest ids: no search for
k rows needs more than the k smallest of them, so copies cost nothing. Nodes are dealt to
shards by a hash; every block of queries meets every shard of its vector length once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftledger.llm.common import hash63
from siftledger.session import materialise

SCALE = 256
SHARD_NODES = 8192
BLOCK_QUERIES = 2048

# Whole numbers below these are exact in the type, so scores with their partial sums are.
_EXACT = ((2**24, np.float32), (2**53, np.float64))
_LONG = np.iinfo(np.int64)


def components(vector: str) -> Column:
    """floor(256 * x) of each component, as long; beyond its range the nearest long."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE))


def rows(embeddings: DataFrame, *more: Column) -> DataFrame:
    """vec_id, v (whole numbers) and ``more`` of the rows that take part.

    Those with a NULL id, a NULL vector or a NULL or non-finite component do not.
    """
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return embeddings.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad).select(
        F.col("vec_id").cast("long").alias("vec_id"), components("embedding").alias("v"), *more
    )


def nodes(rows: DataFrame, keys: list[str], ids: int) -> DataFrame:
    """One row per distinct ``keys`` (vector first): the ``ids`` smallest vec_ids, in order, and
    the first as rep."""
    by_key = Window.partitionBy(*keys).orderBy("vec_id")
    return (
        rows.withColumn("_at", F.row_number().over(by_key))
        .where(F.col("_at") <= ids)
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .select(F.col("ids")[0].alias("rep"), "ids", *keys)
    )


def stored_nodes(nodes: DataFrame, asked: DataFrame, keys: list[str]) -> DataFrame:
    """Nodes with a number of their own, given as they are written, and whether they ask."""
    asked = asked.select(*keys).distinct().withColumn("asked", F.lit(True))
    marked = nodes.join(asked, keys, "left").withColumn("asked", F.coalesce("asked", F.lit(False)))
    return materialise(marked.withColumn("node", F.monotonically_increasing_id()), "nodes")


def dealt(
    nodes: DataFrame, keys: list[str], asked: str, shard_nodes: int, block_queries: int
) -> tuple[DataFrame, DataFrame]:
    """The nodes with their shard, and the asked ones with their block and each shard.

    Shards and blocks are numbered per vector length: vectors of different lengths never
    meet. The counts are broadcast: n different lengths take n * n / 2 components at least,
    so there are few of them against the data.
    """
    sized = nodes.withColumn("dim", F.size(keys[0]))
    counts = sized.groupBy("dim").agg(F.count("*").alias("n"), F.count_if(asked).alias("asks"))
    counts = counts.select(
        "dim",
        F.ceil(F.col("n") / shard_nodes).alias("shards"),
        F.ceil(F.col("asks") / block_queries).alias("blocks"),
    )
    spread = hash63(*keys)
    placed = sized.join(F.broadcast(counts), "dim")
    of_length = F.col("dim") * F.lit(1 << 32)
    sharded = placed.withColumn("shard", of_length + spread % F.col("shards"))
    blocks = (
        placed.where(asked)
        .withColumn("block", spread % F.col("blocks"))
        .withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)))
        .withColumn("shard", of_length + F.col("shard"))
    )
    return sharded, blocks


def matrix(vectors: list) -> np.ndarray:
    """Vectors of one length as rows."""
    m = np.array([np.asarray(v, np.int64) for v in vectors], np.int64)
    return m.reshape(len(vectors), -1)


def as_exact(m: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both arrays in a type whose inner products are exact: floats, else Python integers."""
    largest = [np.abs(x.astype(float)).max(initial=1.0) for x in (m, other)]
    most = largest[0] * largest[1] * max(m.shape[1], 1)
    kind = next((kind for limit, kind in _EXACT if most < limit), object)
    return m.astype(kind), other.astype(kind)


def as_long(scores: np.ndarray) -> np.ndarray:
    """Exact scores as long; beyond its range the nearest long."""
    if scores.dtype == object:
        scores = np.array([min(max(s, _LONG.min), _LONG.max) for s in scores], object)
    return scores.astype(np.int64)


def rows_of(parts: Iterator[pd.DataFrame]) -> Iterator:
    """The rows of a task's batches, one at a time."""
    for part in parts:
        yield from part.itertuples(index=False)


def best_rows(found: DataFrame, of: list[str], nodes: DataFrame, k: int) -> DataFrame:
    """For each ``of``: best, its ``k`` best rows (_at, vec_id, score) in order.

    ``found`` has ``of``, node, rep and score with the ``k`` best nodes of every shard. Every
    node has a row, so the k best nodes hold the k best rows.
    """
    by_node = Window.partitionBy(*of).orderBy(F.desc("score"), "rep", "node")
    by_row = Window.partitionBy(*of).orderBy(F.desc("score"), "vec_id")
    few = found.withColumn("_at", F.row_number().over(by_node)).where(F.col("_at") <= k)
    return (
        few.select(*of, "node", "score")
        .join(nodes.select("node", "ids"), "node")
        .select(*of, "score", F.explode("ids").alias("vec_id"))
        .withColumn("_at", F.row_number().over(by_row))
        .where(F.col("_at") <= k)
        .groupBy(*of)
        .agg(F.sort_array(F.collect_list(F.struct("_at", "vec_id", "score"))).alias("best"))
    )
