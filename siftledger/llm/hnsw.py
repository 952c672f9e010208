"""Nearest neighbours by hierarchical navigable small-world graphs, one per shard.

Equal vectors are one node. Every shard of nodes has a graph of its own, stored as flat
neighbour arrays: for each level the nodes on it and a matrix of their neighbours. Blocks
of queries meet every shard, and the shards' nearest are merged. Inside a task, nodes are
inserted and queries searched in batches, by array operations.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftledger.llm.common import hash63, mixed, table
from siftledger.session import materialise

NEAREST = 20
EVERY = 20
SHARD_NODES = 4096
BLOCK_QUERIES = 1024
# Links per node (twice that on the lowest level), beam while building and searching.
LINKS, BUILD_BEAM, SEARCH_BEAM = 16, 96, 160
_BATCH = 256


@dataclass
class Graph:
    """Vectors and, per level from 0, the nodes on it and their neighbours (-1: none)."""

    vectors: np.ndarray
    nodes: list[np.ndarray] = field(default_factory=list)
    links: list[np.ndarray] = field(default_factory=list)
    row_of: list[np.ndarray] = field(default_factory=list)
    entry: int = 0

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Nodes and inner products, best first; -1 where fewer were found."""
        at = np.full((len(queries), 1), self.entry)
        for level in range(len(self.nodes) - 1, 0, -1):
            at = self.descend(queries, at, level, 1)[0][:, :1]
        return self.descend(queries, at, 0, beam)

    def descend(self, queries, starts, level, beam) -> tuple[np.ndarray, np.ndarray]:
        """Best-first search on one level, for all queries at once."""
        count, wide = len(queries), 4 if beam > 1 else 1
        lines = np.arange(count)[:, None]
        seen = np.zeros((count, len(self.vectors) + 1), bool)
        seen[:, -1] = True  # stands for "none"
        found = np.full((count, beam), -1)
        score = np.full((count, beam), -np.inf, np.float32)
        done = np.ones((count, beam), bool)
        width = min(starts.shape[1], beam)
        found[:, :width] = starts[:, :width]
        valid = found >= 0
        score[valid] = np.einsum(
            "ij,ij->i", queries[np.nonzero(valid)[0]], self.vectors[found[valid]]
        )
        done[valid] = False
        seen[lines, found] = True
        while not done.all():
            rank = np.where(done, -np.inf, score)
            open_ = np.argsort(-rank, axis=1)[:, :wide]
            is_open = ~done[lines, open_]
            nodes = np.where(is_open, found[lines, open_], -1)
            done[lines, open_] = True
            rows = np.where(nodes >= 0, self.row_of[level][nodes], -1)
            near = np.where(rows[..., None] >= 0, self.links[level][rows], -1).reshape(count, -1)
            near = np.sort(near, axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            near[seen[lines, near]] = -1
            seen[lines, near] = True
            s = np.einsum("ij,ikj->ik", queries, self.vectors[near])
            s[near < 0] = -np.inf
            score = np.hstack([score, s])
            found = np.hstack([found, near])
            done = np.hstack([done, near < 0])
            best = np.argpartition(-score, beam - 1, axis=1)[:, :beam]
            score, found, done = score[lines, best], found[lines, best], done[lines, best]
        order = np.argsort(-score, axis=1, kind="stable")
        return found[lines, order], score[lines, order]


def _levels(keys: np.ndarray) -> np.ndarray:
    """Levels with geometric frequency, from a hash of each node's id."""
    draw = (mixed(keys.astype(np.int64).view(np.uint64)) >> np.uint64(11)).astype(float) / 2**53
    return np.minimum((-np.log(draw + 1e-18) / math.log(LINKS)).astype(int), 8)


def build(keys: np.ndarray, vectors: np.ndarray) -> Graph:
    """The graph of a shard's vectors; ``keys`` are their ids."""
    vectors = np.ascontiguousarray(vectors, np.float32)
    n, levels = len(vectors), _levels(keys)
    order = np.argsort(-levels, kind="stable")  # upper levels first: the entry never moves
    graph = Graph(np.vstack([vectors, np.zeros((1, vectors.shape[1]), np.float32)]))
    graph.entry = int(order[0])
    for level in range(int(levels.max()) + 1):
        on = np.flatnonzero(levels >= level)
        row_of = np.full(n + 1, -1, np.int64)
        row_of[on] = np.arange(len(on))
        graph.nodes.append(on)
        graph.row_of.append(row_of)
        graph.links.append(np.full((len(on), LINKS * (2 if level == 0 else 1)), -1, np.int32))
    at, size = 1, 1
    while at < n:
        batch = order[at : at + size]
        _insert(graph, batch, levels)
        at += len(batch)
        size = min(_BATCH, at)
    return graph


def _insert(graph: Graph, batch: np.ndarray, levels: np.ndarray) -> None:
    queries = graph.vectors[batch]
    starts = np.full((len(batch), 1), graph.entry)
    inner = queries @ queries.T
    for level in range(len(graph.nodes) - 1, -1, -1):
        mine = levels[batch] >= level
        found, score = graph.descend(queries, starts, level, BUILD_BEAM if mine.any() else 1)
        starts = found[:, : min(8, found.shape[1])]
        if not mine.any():
            continue
        # The batch does not see itself in the graph: its own members are candidates too.
        own = np.where(mine[None, :] & ~np.eye(len(batch), dtype=bool), inner, -np.inf)
        own_ids = np.broadcast_to(batch, own.shape)
        if own.shape[1] > LINKS:
            best = np.argpartition(-own, LINKS, axis=1)[:, :LINKS]
            rows = np.arange(len(batch))[:, None]
            own, own_ids = own[rows, best], own_ids[rows, best]
        ids = np.hstack([found, np.where(np.isfinite(own), own_ids, -1)])[mine]
        scores = np.hstack([score, own.astype(np.float32)])[mine]
        chosen = _spread(graph.vectors, ids, scores, LINKS)
        _connect(graph, level, batch[mine], chosen)


def _spread(vectors: np.ndarray, ids: np.ndarray, scores: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` neighbours each, nearest first, that are nearer to the node than to
    neighbours chosen before; then the nearest of the others."""
    rows = np.arange(len(ids))[:, None]
    order = np.argsort(-scores, axis=1, kind="stable")[:, : 3 * most]
    ids, scores = ids[rows, order], scores[rows, order]
    v = vectors[ids]
    among = np.einsum("ijd,ikd->ijk", v, v)
    keep = np.zeros(ids.shape, bool)
    closest = np.full(ids.shape, -np.inf, np.float32)
    for k in range(ids.shape[1]):
        good = (ids[:, k] >= 0) & (scores[:, k] > closest[:, k]) & (keep.sum(1) < most)
        keep[:, k] = good
        closest = np.maximum(closest, np.where(good[:, None], among[:, k, :], -np.inf))
    rank = np.where(ids < 0, 2, np.where(keep, 0, 1)) * ids.shape[1] + np.arange(ids.shape[1])
    best = np.argsort(rank, axis=1)[:, :most]
    return ids[rows, best]


def _connect(graph: Graph, level: int, nodes: np.ndarray, chosen: np.ndarray) -> None:
    """Link nodes and neighbours both ways; a full neighbour keeps its nearest links."""
    links, row_of = graph.links[level], graph.row_of[level]
    links[row_of[nodes], : chosen.shape[1]] = chosen
    source = np.repeat(nodes, chosen.shape[1])
    target = chosen.ravel()
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    begins = np.flatnonzero(np.r_[True, target[1:] != target[:-1]]) if len(target) else []
    if not len(begins):
        return
    unique = target[begins]
    sizes = np.diff(np.append(begins, len(target)))
    place = np.arange(len(target)) - np.repeat(begins, sizes)
    new = np.full((len(unique), sizes.max()), -1)
    new[np.repeat(np.arange(len(unique)), sizes), place] = source
    merged = np.hstack([links[row_of[unique]], new])
    merged.sort(axis=1)
    merged[:, 1:][merged[:, 1:] == merged[:, :-1]] = -1
    score = np.einsum("id,ikd->ik", graph.vectors[unique], graph.vectors[merged])
    score[merged < 0] = -np.inf
    best = np.argsort(-score, axis=1, kind="stable")[:, : links.shape[1]]
    links[row_of[unique]] = np.take_along_axis(merged, best, 1)


_INDEX = "shard long, keys binary, vectors binary, graph binary"


def _build_shard(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("rep")
    keys = rows["rep"].to_numpy(np.int64)
    vectors = np.array(rows["embedding"].tolist(), np.float64)
    graph = build(keys, vectors)
    flat = pickle.dumps((graph.nodes, graph.links, graph.entry), protocol=5)
    return pd.DataFrame(
        [(rows["shard"].iloc[0], keys.tobytes(), vectors.tobytes(), flat)],
        columns=["shard", "keys", "vectors", "graph"],
    )


def _load(keys: bytes, vectors: bytes, flat: bytes) -> tuple[np.ndarray, np.ndarray, Graph]:
    keys = np.frombuffer(keys, np.int64)
    exact = np.frombuffer(vectors, np.float64).reshape(len(keys), -1)
    nodes, links, entry = pickle.loads(flat)
    graph = Graph(np.vstack([exact, np.zeros((1, exact.shape[1]))]).astype(np.float32), nodes, links)
    for on in nodes:
        row_of = np.full(len(keys) + 1, -1, np.int64)
        row_of[on] = np.arange(len(on))
        graph.row_of.append(row_of)
    graph.entry = entry
    return keys, exact, graph


def _search(nearest: int):
    """Search a shard for a block of queries: the ``nearest`` nodes of each."""

    def search(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for row in part.to_pylist():
                keys, exact, graph = _load(row["keys"], row["vectors"], row["graph"])
                names = np.array([q["rep"] for q in row["queries"]], np.int64)
                wanted = np.array([q["embedding"] for q in row["queries"]], np.float64)
                for at in range(0, len(names), _BATCH):
                    q = wanted[at : at + _BATCH]
                    found, _ = graph.search(q.astype(np.float32), max(SEARCH_BEAM, nearest))
                    score = np.einsum("ij,ikj->ik", q, exact[found])
                    score[found < 0] = -np.inf
                    best = np.lexsort((keys[found], -score), axis=1)[:, :nearest]
                    ids = keys[np.take_along_axis(found, best, 1)]
                    score = np.take_along_axis(score, best, 1)
                    name = np.repeat(names[at : at + _BATCH], ids.shape[1])
                    good = np.isfinite(score.ravel())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(name[good], pa.int64()),
                            pa.array(ids.ravel()[good], pa.int64()),
                            pa.array(score.ravel()[good], pa.float64()),
                        ],
                        names=["query_rep", "rep", "score"],
                    )

    return search


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id, embedding (doubles) and dim, without vectors that take no part.

    NULL vectors, NULL ids, empty and zero vectors and those with a NULL or non-finite
    component are left out. Vectors of different lengths never meet.
    """
    e = F.col("embedding")
    bad = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        embeddings.select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col("embedding").cast("array<double>").alias("embedding"),
        )
        .where("vec_id is not null")
        .where(e.isNotNull() & ~bad & F.exists(e, lambda x: x != 0))
        .withColumn("dim", F.size(e))
    )


def nearest(
    embeddings: DataFrame,
    is_query: str,
    k: int = NEAREST,
    shard_nodes: int = SHARD_NODES,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest found by largest inner product.

    ``is_query`` is a condition on vec_id. A query's own row is no candidate, rows with an
    equal vector are. Rows that repeat a vec_id and vector are one row. An empty table
    gives an empty result.
    """
    rows = materialise(usable(embeddings).dropDuplicates(["vec_id", "embedding"]), "vectors")
    # Of rows with one vector, only the k + 1 smallest ids can be among anyone's nearest.
    by_vector = Window.partitionBy("embedding").orderBy("vec_id")
    members = (
        rows.withColumn("_at", F.row_number().over(by_vector))
        .where(F.col("_at") <= k + 1)
        .groupBy("embedding")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )
    asked = rows.where(is_query).select("embedding").distinct().withColumn("asked", F.lit(True))
    nodes = materialise(
        members.join(asked, "embedding", "left").select(
            F.col("ids")[0].alias("rep"),
            "ids",
            "embedding",
            F.size("embedding").alias("dim"),
            F.coalesce("asked", F.lit(False)).alias("asked"),
        ),
        "nodes",
    )
    sizes = nodes.groupBy("dim").agg(F.count("*").alias("n"), F.count_if("asked").alias("asked"))
    # A row per vector length: how many shards and query blocks it has.
    sizes = sizes.select(
        "dim",
        F.ceil(F.col("n") / shard_nodes).alias("shards"),
        F.ceil(F.col("asked") / block_queries).alias("blocks"),
    )
    placed = nodes.join(sizes, "dim")
    spread = hash63("rep", "embedding")
    index = (
        placed.withColumn("shard", F.col("dim") * (1 << 32) + spread % F.col("shards"))
        .select("shard", "rep", "embedding")
        .groupBy("shard")
        .applyInPandas(_build_shard, _INDEX)
    )
    index = materialise(index, "graphs")
    blocks = (
        placed.where("asked")
        .withColumn("block", spread % F.col("blocks"))
        .groupBy("dim", "block", "shards")
        .agg(F.collect_list(F.struct("rep", "embedding")).alias("queries"))
        .withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)))
        .withColumn("shard", F.col("dim") * (1 << 32) + F.col("shard"))
        .select("shard", "block", "queries")
    )
    pairs = blocks.join(index, "shard").select("keys", "vectors", "graph", "queries")
    found = pairs.mapInArrow(_search(k + 1), "query_rep long, rep long, score double")
    best = Window.partitionBy("query_rep").orderBy(F.desc("score"), "rep")
    found = found.withColumn("_at", F.row_number().over(best)).where(F.col("_at") <= k + 1)
    # Nodes to rows, still per distinct query vector.
    by_score = Window.partitionBy("query_rep").orderBy(F.desc("score"), "vec_id")
    listed = (
        found.join(nodes.select("rep", "ids"), "rep")
        .select("query_rep", "score", F.explode("ids").alias("vec_id"))
        .withColumn("_at", F.row_number().over(by_score))
        .where(F.col("_at") <= k + 1)
        .groupBy("query_rep")
        .agg(F.sort_array(F.collect_list(F.struct("_at", "vec_id", "score"))).alias("near"))
    )
    queries = (
        rows.where(is_query)
        .join(nodes.where("asked").select("embedding", F.col("rep").alias("query_rep")), "embedding")
        .select(F.col("vec_id").alias("query_id"), "query_rep")
        .join(listed, "query_rep")
    )
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return queries.select("query_id", F.posexplode(others).alias("at", "x")).select(
        "query_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("x.vec_id").alias("vec_id"),
        F.col("x.score").alias("score"),
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(table(spark, folder, "embeddings"), f"vec_id % {EVERY} = 0")
