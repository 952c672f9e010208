"""Exact top-k search by inner product, with MaxScore over postings of signed dimensions.

A term is a dimension with a sign; its postings are a shard's nodes whose component has
that sign, with the largest magnitude as its bound. For a query, the term of the same sign
as its component adds to scores, the other one only takes away and has the bound 0. Terms
whose bounds together stay below the k-th best score so far are not essential: a node in
no essential posting list cannot enter. Essential lists are traversed and added up, the
other terms are probed, greatest bounds first, for the nodes that can still compete.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftledger.llm import integer_vectors as iv
from siftledger.llm.common import table
from siftledger.session import materialise

TOP = 5
EVERY = 50
# Dimensions probed at a time.
_PROBES = 8


class Shard:
    """Vectors of nodes, and the postings of each (dimension, sign) with its bound."""

    def __init__(self, vectors: np.ndarray, rows: np.ndarray, ends: np.ndarray):
        """``rows``: the rows of the postings, term after term (dimension 0 +, dimension 0 -,
        1 +, ...). ``vectors`` have a type whose inner products are exact."""
        self.vectors, self.columns = vectors, np.ascontiguousarray(vectors.T)
        self.rows, self.ends = rows.astype(np.intp), ends
        self.impacts = np.concatenate(
            [self.columns[t // 2][self._part(self.rows, t)] for t in range(len(ends))]
            or [np.empty(0, vectors.dtype)]
        )
        self.bounds = [(c.max(initial=0), -c.min(initial=0)) for c in self.columns]

    def _part(self, array: np.ndarray, term: int) -> np.ndarray:
        return array[self.ends[term - 1] if term else 0 : self.ends[term]]

    def posting(self, dimension: int, sign: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and components."""
        term = 2 * dimension + int(sign < 0)
        return self._part(self.rows, term), self._part(self.impacts, term)


def postings(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of each term's postings, and where each ends."""
    lists = [np.flatnonzero(sign * column > 0) for column in vectors.T for sign in (1, -1)]
    rows = np.concatenate([*lists, np.empty(0, int)]).astype(np.int32)
    return rows, np.cumsum([len(x) for x in lists], dtype=np.int64)


def competitive(shard: Shard, query: np.ndarray, k: int) -> np.ndarray:
    """Rows of the shard that can hold one of its ``k`` best scores, ties included."""
    vectors, columns = shard.vectors, shard.columns
    everything = np.arange(len(vectors))
    if len(vectors) <= 4 * k or not query.any():
        return everything
    used = np.flatnonzero(query != 0)
    sign = np.where(query[used] > 0, 1, -1)
    most = np.array([shard.bounds[d][int(s < 0)] for d, s in zip(used, sign)], vectors.dtype)
    bound = np.abs(query[used]) * most
    order = np.argsort(-bound, kind="stable")
    used, sign, bound = used[order], sign[order], bound[order]
    # What the terms from each place on can add at most.
    rest = np.append(np.cumsum(bound[::-1])[::-1], [0 * bound[0]])

    # Whole scores of the greatest impacts of one list give a first k-th best.
    first, impact = shard.posting(used[0], sign[0])
    if len(first) < k:
        return everything
    first = first[_largest(np.abs(impact), 8 * k)]
    threshold = _kth(vectors[first] @ query, k)
    if threshold <= 0:  # nodes in no list that adds may be among the best
        return everything

    essential = int(np.count_nonzero(rest[:-1] >= threshold))
    gained = np.zeros(len(vectors), vectors.dtype)
    seen = np.zeros(len(vectors), bool)
    for dimension, s in zip(used[:essential], sign[:essential]):
        rows, impact = shard.posting(dimension, s)
        gained[rows] += impact * query[dimension]
        seen[rows] = True
    alive = np.flatnonzero(seen & (gained + rest[essential] >= threshold))
    score = gained[alive]

    # First what the essential dimensions take away, then the other dimensions.
    for at in [*range(0, essential, _PROBES), *range(essential, len(used), _PROBES)]:
        taken = at < essential
        upto = min(at + _PROBES, essential if taken else len(used))
        if len(alive) > 8 * k:  # the whole scores of those that lead raise the threshold
            lead = alive[_largest(score, 2 * k)]
            threshold = max(threshold, _kth(vectors[lead] @ query, k))
        for dimension in used[at:upto]:
            part = columns[dimension][alive] * query[dimension]
            score += np.minimum(part, 0) if taken else part
        keep = score + rest[essential if taken else upto] >= threshold
        alive, score = alive[keep], score[keep]
    return alive


def _largest(values: np.ndarray, n: int) -> np.ndarray:
    return np.argpartition(values, -n)[-n:] if len(values) > n else np.arange(len(values))


def _kth(scores: np.ndarray, k: int):
    return np.sort(scores)[-k]


_INDEX = "shard long, nodes binary, reps binary, vectors binary, postings binary, ends binary"


def _build(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["rep", "node"])
    vectors = iv.matrix(rows["v"].tolist())
    flat = (
        rows["node"].to_numpy(np.int64),
        rows["rep"].to_numpy(np.int64),
        vectors,
        *postings(vectors),
    )
    names = [column.split()[0] for column in _INDEX.split(", ")]
    return pd.DataFrame([(rows["shard"].iloc[0], *(x.tobytes() for x in flat))], columns=names)


_FOUND = "query_node long, node long, rep long, score long"


def _search(k: int):
    """The ``k`` best nodes of a shard for each query of a block."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for row in iv.rows_of(parts):
            nodes, reps = np.frombuffer(row.nodes, np.int64), np.frombuffer(row.reps, np.int64)
            held = np.frombuffer(row.vectors, np.int64).reshape(len(nodes), -1)
            vectors, queries = iv.as_exact(held, iv.matrix([q["v"] for q in row.queries]))
            listed = np.frombuffer(row.postings, np.int32), np.frombuffer(row.ends, np.int64)
            shard = Shard(vectors, *listed)
            found = []
            for asked, query in zip(row.queries, queries):
                rows = competitive(shard, query, k)
                score = vectors[rows] @ query
                best = np.argsort(-score, kind="stable")[:k]  # rows are in order of rep
                found.append((asked["node"], rows[best], score[best]))
            at = np.concatenate([at for _, at, _ in found])
            yield pd.DataFrame(
                {
                    "query_node": np.repeat([n for n, *_ in found], [len(x) for _, x, _ in found]),
                    "node": nodes[at],
                    "rep": reps[at],
                    "score": iv.as_long(np.concatenate([score for *_, score in found])),
                }
            )

    return run


def top(
    embeddings: DataFrame,
    is_query: str,
    k: int = TOP,
    shard_nodes: int = iv.SHARD_NODES,
    block_queries: int = iv.BLOCK_QUERIES,
) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` best other rows for each query, exactly.

    ``is_query`` is a condition on vec_id; components become floor(256 * x). Ties go to the
    smaller vec_id. NULL ids, NULL vectors and those with a NULL or non-finite component
    take no part; zero vectors do; vectors of different lengths never meet. Rows that repeat
    an id and vector are one row, and a row is no candidate for a query of its own id.
    Components and scores beyond the range of long are taken as the nearest long. An empty
    table gives an empty result; other columns do not matter.
    """
    rows = iv.rows(embeddings).dropDuplicates(["vec_id", "v"])
    rows = materialise(rows, "integer-vectors")
    nodes = iv.stored_nodes(iv.nodes(rows, ["v"], k + 1), rows.where(is_query), ["v"])
    sharded, blocks = iv.dealt(nodes, ["v"], "asked", shard_nodes, block_queries)
    index = sharded.select("shard", "node", "rep", "v").groupBy("shard")
    index = materialise(index.applyInPandas(_build, _INDEX), "postings")
    queries = blocks.groupBy("shard", "block").agg(
        F.collect_list(F.struct("node", "v")).alias("queries")
    )
    found = queries.join(index, "shard").drop("shard", "block").mapInPandas(_search(k + 1), _FOUND)
    listed = iv.best_rows(found, ["query_node"], nodes, k + 1)
    others = F.slice(F.filter("best", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return (
        rows.where(is_query)
        .join(nodes.where("asked").select("v", F.col("node").alias("query_node")), "v")
        .select(F.col("vec_id").alias("query_id"), "query_node")
        .join(listed, "query_node")
        .select("query_id", F.posexplode(others).alias("at", "x"))
        .select(
            "query_id",
            (F.col("at") + 1).cast("int").alias("rank"),
            F.col("x.vec_id").alias("vec_id"),
            F.col("x.score").alias("score"),
        )
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    return top(table(spark, folder, "embeddings"), f"vec_id % {EVERY} = 0")


SQL = f"""
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e)
  WHERE q.vec_id % {EVERY} = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM pairs
)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= {TOP}
"""
