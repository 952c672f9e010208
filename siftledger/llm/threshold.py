"""Hard negatives by Fagin's threshold algorithm over per-dimension sorted lists.

A shard keeps its nodes sorted by each component. For an anchor, every list is read from
the end that its component's sign prefers; a node met for the first time is scored by
random access. A node not met yet cannot score more than the sum of what the lists show at
the depth reached, so reading stops once that threshold is strictly below the k-th best
score inside each window that the anchor asks for. Positives are one window without
bounds over rows of the anchor's label; each positive then gives a window of scores for
rows of other labels.
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

POSITIVES, NEGATIVES = 5, 10
# A negative's score lies between these tenths of its positive's.
LOWEST, HIGHEST = 3, 9
EVERY = 100
# Every so many ids the label is moved on by one, modulo the number of labels.
RELABELLED, LABELS = 7, 10
# Places read from every list at first; each time four times as many.
_DEPTH = 64


def sorted_access(
    vectors: np.ndarray,
    order: np.ndarray,
    wanted: np.ndarray,
    query: np.ndarray,
    windows: list[tuple[int | None, int | None]],
    k: int,
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each window (lowest and highest score, None: no bound): rows and scores of the
    ``k`` best wanted rows inside, in order, ties in the order of rows.

    ``order``: per dimension, the rows in ascending order of the component. ``wanted``: a
    mask of rows. ``vectors`` and ``query`` have a type whose inner products are exact.
    """
    n = len(vectors)
    used = np.flatnonzero(query != 0)
    down, up = used[query[used] > 0], used[query[used] < 0]
    unseen = wanted.copy()
    rows, scores = np.empty(0, int), np.empty(0, vectors.dtype)
    best: list = [None] * len(windows)
    open_ = set(range(len(windows)))
    at, depth = 0, _DEPTH
    while open_:
        if depth < n and len(used):
            met = np.zeros(n, bool)
            met[order[down, n - depth : n - at]] = True
            met[order[up, at:depth]] = True
            fresh = np.flatnonzero(met & unseen)
            last = np.concatenate([order[down, n - depth], order[up, depth - 1]])
            of = np.concatenate([down, up])
            threshold = vectors[last, of] @ query[of]
        else:
            fresh, threshold = np.flatnonzero(unseen), None
        unseen[fresh] = False
        rows = np.concatenate([rows, fresh])
        scores = np.concatenate([scores, vectors[fresh] @ query])
        if not unseen.any():
            threshold = None  # no row is left to meet
        for w in list(open_):
            low, high = windows[w]
            if threshold is not None and high is not None and threshold >= high:
                continue  # no k-th score inside can exceed the threshold yet
            inside = np.ones(len(rows), bool)
            if low is not None:
                inside &= scores >= low
            if high is not None:
                inside &= scores <= high
            inside = np.flatnonzero(inside)
            floor = low
            if threshold is not None and len(inside) >= k:
                floor = np.sort(scores[inside])[-k]
            if threshold is None or (floor is not None and threshold < floor):
                ranked = inside[np.lexsort((rows[inside], -scores[inside]))[:k]]
                best[w] = rows[ranked], scores[ranked]
                open_.discard(w)
        at, depth = depth, 4 * depth
    return best


_INDEX = "shard long, nodes binary, reps binary, labels binary, vectors binary, sorted binary"


def _build(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["rep", "node"])
    vectors = iv.matrix(rows["v"].tolist())
    flat = (
        rows["node"].to_numpy(np.int64),
        rows["rep"].to_numpy(np.int64),
        rows["label"].to_numpy(np.int64),
        vectors,
        np.argsort(vectors, axis=0, kind="stable").T.astype(np.int32),
    )
    names = [column.split()[0] for column in _INDEX.split(", ")]
    return pd.DataFrame([(rows["shard"].iloc[0], *(x.tobytes() for x in flat))], columns=names)


_FOUND = "query_node long, positive_score long, node long, rep long, score long"


def _search(k: int, same_label: bool):
    """The ``k`` best nodes of a shard in each window of each query of a block.

    ``same_label``: one window without bounds over nodes of the query's label; else one per
    positive score that the query brings, over nodes of other labels.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for row in iv.rows_of(parts):
            nodes, reps, labels = (
                np.frombuffer(x, np.int64) for x in (row.nodes, row.reps, row.labels)
            )
            held = np.frombuffer(row.vectors, np.int64).reshape(len(nodes), -1)
            order = np.frombuffer(row.sorted, np.int32).reshape(-1, len(nodes))
            vectors, queries = iv.as_exact(held, iv.matrix([q["v"] for q in row.queries]))
            found = []
            for asked, query in zip(row.queries, queries):
                positives = [None] if same_label else [int(p) for p in asked["positives"]]
                windows = [(None, None)] if same_label else [window(p) for p in positives]
                wanted = (labels == asked["label"]) == same_label
                best = sorted_access(vectors, order, wanted, query, windows, k)
                found += [(asked["node"], p, *b) for p, b in zip(positives, best)]
            sizes = [len(at) for _, _, at, _ in found]
            at = np.concatenate([at for _, _, at, _ in found])
            yield pd.DataFrame(
                {
                    "query_node": np.repeat([node for node, *_ in found], sizes),
                    "positive_score": pd.array([p for _, p, *_ in found], "Int64").repeat(sizes),
                    "node": nodes[at],
                    "rep": reps[at],
                    "score": iv.as_long(np.concatenate([score for *_, score in found])),
                }
            )

    return run


def window(positive_score: int) -> tuple[int, int]:
    """Lowest and highest score of its negatives, rounded inwards."""
    return -(-LOWEST * positive_score // 10), HIGHEST * positive_score // 10


def labelled(embeddings: DataFrame) -> DataFrame:
    """Rows with the label moved on by one where vec_id is divisible by seven."""
    moved = F.when(F.col("vec_id") % RELABELLED == 0, (F.col("label") + 1) % LABELS)
    return embeddings.withColumn("label", moved.otherwise(F.col("label")).cast("long"))


def hard_negatives(
    embeddings: DataFrame,
    is_anchor: str,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    shard_nodes: int = iv.SHARD_NODES,
    block_queries: int = iv.BLOCK_QUERIES,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``is_anchor`` is a condition on vec_id. An anchor's positives are its best rows of the
    same label and another id; each has its best rows of other labels whose score lies in
    the positive's window. Components become floor(256 * x); ties go to the smaller vec_id.
    Rows with a NULL id, label or vector, or a NULL or non-finite component, take no part;
    vectors of different lengths never meet. Rows that repeat an id, vector and label are
    one row; rows of one id that differ are an anchor each. Components and scores beyond the
    range of long are taken as the nearest long. An empty table gives an empty result; other
    columns do not matter.
    """
    own = F.col("label").cast("long").alias("label")
    rows = iv.rows(embeddings.where("label is not null"), own)
    rows = materialise(rows.dropDuplicates(["vec_id", "v", "label"]), "labelled-vectors")
    keys = ["v", "label"]
    nodes = iv.nodes(rows, keys, max(positives + 1, negatives))
    nodes = iv.stored_nodes(nodes, rows.where(is_anchor), keys)
    sharded, blocks = iv.dealt(nodes, keys, "asked", shard_nodes, block_queries)
    index = sharded.select("shard", "node", "rep", *keys).groupBy("shard")
    index = materialise(index.applyInPandas(_build, _INDEX), "sorted-lists")

    def searched(queries: DataFrame, k: int, same_label: bool) -> DataFrame:
        columns = [c for c in queries.columns if c not in ("shard", "block")]
        queries = queries.groupBy("shard", "block").agg(
            F.collect_list(F.struct(*columns)).alias("queries")
        )
        pairs = queries.join(index, "shard").drop("shard", "block")
        return pairs.mapInPandas(_search(k, same_label), _FOUND)

    blocks = blocks.select("shard", "block", "node", *keys)
    found = searched(blocks, positives + 1, same_label=True)
    listed = iv.best_rows(found, ["query_node"], nodes, positives + 1)
    others = F.slice(F.filter("best", lambda x: x["vec_id"] != F.col("anchor_id")), 1, positives)
    anchors = (
        rows.where(is_anchor)
        .join(nodes.where("asked").select("node", *keys), keys)
        .select(F.col("vec_id").alias("anchor_id"), F.col("node").alias("query_node"))
        .join(listed, "query_node")
        .select("anchor_id", "query_node", F.explode(others).alias("x"))
        .select(
            "anchor_id",
            "query_node",
            F.col("x.vec_id").alias("positive_id"),
            F.col("x.score").alias("positive_score"),
        )
    )
    anchors = materialise(anchors, "positives")
    scores = anchors.groupBy(F.col("query_node").alias("node")).agg(
        F.collect_set("positive_score").alias("positives")
    )
    found = searched(blocks.join(scores, "node"), negatives, same_label=False)
    listed = iv.best_rows(found, ["query_node", "positive_score"], nodes, negatives)
    return (
        anchors.join(listed, ["query_node", "positive_score"])
        .select("anchor_id", "positive_id", "positive_score", F.explode("best").alias("x"))
        .select(
            "anchor_id",
            "positive_id",
            F.col("x._at").alias("rank"),
            F.col("x.vec_id").alias("negative_id"),
            "positive_score",
            F.col("x.score").alias("negative_score"),
        )
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives(labelled(table(spark, folder, "embeddings")), f"vec_id % {EVERY} = 0")


SQL = f"""
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e,
    CASE WHEN vec_id % {RELABELLED} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.vec_id AS anchor_id, o.vec_id, a.label = o.label AS same,
    CAST(list_dot_product(a.e, o.e) AS BIGINT) AS score
  FROM v a JOIN v o ON len(a.e) = len(o.e) AND (a.vec_id <> o.vec_id OR a.label <> o.label)
  WHERE a.vec_id % {EVERY} = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score
  FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}
), ranked AS (
  SELECT p.anchor_id, p.positive_id, n.vec_id AS negative_id, p.positive_score,
    n.score AS negative_score, row_number() OVER (
      PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS r
  FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
    AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
)
SELECT anchor_id, positive_id, CAST(r AS INTEGER) AS rank, negative_id, positive_score,
  negative_score
FROM ranked WHERE r <= {NEGATIVES}
"""
