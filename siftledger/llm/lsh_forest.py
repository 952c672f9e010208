"""Near duplicates by an LSH forest of MinHash signatures, with exact confirmation.

Texts of one shingle set are one node. Each tree of the forest is an order of signature
values: nodes sorted by it have their most similar ones next to them. In a first round
every node is compared with its neighbours of the longest common prefix, as found over
all trees. A region is the nodes that share a tree's first values; the second round takes
every region that the first has left in several components, and gathers nodes that look
similar, over all regions, into clusters. Within a region and within a cluster all nodes
of different components are compared, in pairs of bounded blocks, so no region's pairs
are passed over and no task holds a whole region; what leaves a task is a spanning forest,
never all pairs. All links are confirmed on whole shingle sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftledger.llm.common import (
    fresh,
    mixed,
    shuffle_partitions,
    strings,
    table,
    worker_memory,
)
from siftledger.llm.graph import components
from siftledger.session import materialise

SHINGLE = 5
# Linked: 100 * intersection >= percent * union. This is the least of query op3.
PERCENT = 85
# Signature values that nodes of a region share.
DEPTH = 4
# Probability that a pair of exactly the least similarity shares no region, and that it
# looks too dissimilar by its signature.
MISSED = 1e-5
UNLIKE = 4e-5
# Nodes of a region that one task compares with as many others.
CROWDED = 2_000
# Neighbours by common prefix that a node is compared with in the first round.
NEIGHBOURS = 2
# Nodes of a cluster that one task compares with as many others.
BLOCK = 500
# Ids a broadcast may hold (20 MB); more are joined in a shuffle.
MAX_BROADCAST = 1_000_000
# Words a worker remembers at once; a forgotten word is hashed again.
REMEMBERED = 300_000


class Limits(NamedTuple):
    """What follows from the least similarity: orders, signature values, equal values."""

    percent: int
    trees: int
    values: int
    likely: int


def limits(percent: int) -> Limits:
    """Enough orders of DEPTH separate values, and the equal values that a pair must have."""
    if not 1 <= percent <= 100:
        raise ValueError(f"percent must be from 1 to 100, not {percent}")
    s = min(percent, 99) / 100
    trees = math.ceil(math.log(MISSED) / math.log1p(-(s**DEPTH)))
    values = trees * DEPTH
    below, likely = 0.0, 0
    while True:
        logs = math.lgamma(values + 1) - math.lgamma(likely + 1) - math.lgamma(values - likely + 1)
        below += math.exp(logs + likely * math.log(s) + (values - likely) * math.log1p(-s))
        if below > UNLIKE:
            return Limits(percent, trees, values, likely)
        likely += 1


@lru_cache
def _drawn(values: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20240101)
    odd = draw.integers(1, 1 << 32, values, np.uint32) | np.uint32(1)
    return odd, draw.integers(0, 1 << 32, values, np.uint32)


_ODD = np.uint64(0x9E3779B97F4A7C15)


class _Known(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def shingles(text: str, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles: words in lower case A-Z."""
    known = worker_memory("shingles", _Known)
    words = text.encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    codes = np.fromiter(map(known.__getitem__, words), np.uint64, n)
    width = min(size, n)
    total = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        total = total * _ODD + codes[i : i + n - width + 1]
    return np.unique(mixed(total))


def signature(hashes: np.ndarray, values: int) -> bytes:
    """Least values under ``values`` hash functions, as big-endian bytes (which sort alike)."""
    a, b = _drawn(values)
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(values, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 2048):
        least = np.minimum(least, (x[at : at + 2048, None] * a + b).min(axis=0))
    return least.astype(">u4").tobytes()


def _key(hashes: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    return xxhash.xxh3_128_digest(hashes.tobytes())


_SIGNED = "doc_id long, text_hash long, n_shingles long, key binary, signature binary"


def _sign(parts: Iterator[pa.RecordBatch], values: int) -> Iterator[pa.RecordBatch]:
    for part in parts:
        sizes, keys, signatures = [], [], []
        for text in strings(part.column(1)):
            found = shingles(text)
            sizes.append(len(found))
            keys.append(_key(found))
            signatures.append(signature(found, values) if len(found) else None)
        yield pa.RecordBatch.from_arrays(
            [
                part.column(0),
                part.column(2),
                pa.array(sizes, pa.int64()),
                pa.array(keys, pa.binary()),
                pa.array(signatures, pa.binary()),
            ],
            names=["doc_id", "text_hash", "n_shingles", "key", "signature"],
        )


def _sets(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        found = [shingles(text) for text in strings(part.column(0))]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([_key(x) for x in found], pa.binary()),
                pa.array([x.tobytes() for x in found], pa.binary()),
            ],
            names=["key", "hashes"],
        )


def _prefix(order: str, depth: int):
    """The first ``depth`` values of an order, which begins at byte ``order`` of a signature."""
    return F.expr(f"substring(concat(signature, signature), {order} + 1, {4 * depth})")


def regions(nodes: DataFrame, least: Limits) -> DataFrame:
    """``nodes`` once per order, with the order's number and their prefix."""
    numbered = nodes.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(least.trees - 1))))
    return numbered.withColumn("region", _prefix(f"tree * {4 * DEPTH}", DEPTH))


def neighbours(nodes: DataFrame, least: Limits) -> DataFrame:
    """u, v: each node and those before it in the trees that share its longest prefixes.

    A region with more rows than a task's share is cut at a greater depth, and by a hash
    of node and tree, so that the trees still connect the parts; there are fewer of those
    than shares, and they are broadcast.
    """
    spark = nodes.sparkSession
    spread = regions(nodes.select("node", "signature"), least).select(
        "node", "tree", "region", _prefix(f"tree * {4 * DEPTH}", 2 * DEPTH).alias("order")
    )
    shares = 4 * shuffle_partitions(spark)
    rows = nodes.count() * least.trees
    hot = (
        spread.groupBy("tree", "region")
        .count()
        .where(F.col("count") > max(2 * rows / shares, 2))
        .select("tree", "region", F.lit(True).alias("hot"))
    )
    salt = F.pmod(F.xxhash64("node", "tree"), F.lit(16))
    placed = (
        spread.join(F.broadcast(hot), ["tree", "region"], "left")
        .withColumn("part", F.when(F.col("hot"), F.col("order")).otherwise(F.lit(b"")))
        .withColumn("salt", F.when(F.col("hot"), salt).otherwise(F.lit(0)))
    )
    in_order = Window.partitionBy("tree", "region", "part", "salt").orderBy("order", "node")
    before = placed.withColumn("other", F.lag("node").over(in_order)).withColumn(
        "theirs", F.lag("order").over(in_order)
    )
    shared = sum(
        (F.substring("order", 1, 4 * k) == F.substring("theirs", 1, 4 * k)).cast("int")
        for k in range(DEPTH, 2 * DEPTH + 1)
    )
    pairs = (
        before.where("other is not null")
        .groupBy("node", "other")
        .agg(F.max(shared).alias("shared"), F.count("*").alias("trees"))
    )
    best = Window.partitionBy("node").orderBy(F.desc("shared"), F.desc("trees"), "other")
    return (
        pairs.withColumn("_at", F.row_number().over(best))
        .where(F.col("_at") <= NEIGHBOURS)
        .select(F.col("node").alias("u"), F.col("other").alias("v"))
    )


def paired(members: DataFrame, groups: list[str], block: int) -> DataFrame:
    """``members`` (with ``groups``, node and root) once per task: part, rest, member, asks.

    Groups of one component are left out. The nodes of a group outside its largest
    component (``rest``) ask all its members: about ``block`` of them ask about ``block``
    members in a part, and each node is in the parts of its own members' block and, if it
    asks, of its own block of askers. Of two nodes that both ask, the lesser one does.
    """
    sizes = (
        members.groupBy(*groups, "root")
        .agg(F.count("*").alias("_n"))
        .groupBy(*groups)
        .agg(
            F.sum("_n").alias("_all"),
            F.max("_n").alias("_most"),
            F.max_by("root", F.struct("_n", "root")).alias("_top"),
        )
        .where("_all > _most")
    )
    parts = """
        array_distinct(concat(
            transform(sequence(0L, _askers - 1), x -> struct(_mine AS block, x AS askers)),
            if(rest, transform(sequence(0L, _blocks - 1), x -> struct(x AS block, _of AS askers)), array())
        ))
    """
    return (
        members.join(sizes, groups)
        .withColumn("rest", F.col("root") != F.col("_top"))
        .withColumn("_blocks", F.ceil(F.col("_all") / block))
        .withColumn("_askers", F.ceil((F.col("_all") - F.col("_most")) / block))
        .withColumn("_mine", F.pmod(F.xxhash64("node"), F.col("_blocks")))
        .withColumn("_of", F.pmod(F.xxhash64("node", F.lit("askers")), F.col("_askers")))
        .withColumn("part", F.explode(F.expr(parts)))
        .withColumn("member", F.col("part.block") == F.col("_mine"))
        .withColumn("asks", F.col("rest") & (F.col("part.askers") == F.col("_of")))
        .withColumn("part", F.concat_ws("-", "part.block", "part.askers"))
        .drop("_all", "_most", "_top", "_blocks", "_askers", "_mine", "_of")
    )


def _likely_pairs(parts: Iterator[pa.RecordBatch], least: Limits) -> Iterator[pa.RecordBatch]:
    """Per part of a region (rows arrive sorted): a spanning forest of the similar-looking
    nodes of different components."""
    held: list[tuple] = []
    out_u: list[int] = []
    out_v: list[int] = []

    def close():
        if len(held) > 1:
            _compare(held, least, out_u, out_v)
        held.clear()

    last = None
    for batch in parts:
        for tree, region, part, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if (tree, region, part) != last:
                close()
                last = (tree, region, part)
            held.append(row)
        if len(out_u) > 10_000:
            yield _pairs(out_u, out_v)
    close()
    yield _pairs(out_u, out_v)


def _pairs(u: list[int], v: list[int]) -> pa.RecordBatch:
    made = pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])
    u.clear()
    v.clear()
    return made


def _compare(held: list[tuple], least: Limits, out_u: list[int], out_v: list[int]) -> None:
    node, root, size = (np.array(x, np.int64) for x in list(zip(*held))[:3])
    rest, member, asks = (np.array(x, bool) for x in list(zip(*held))[3:6])
    values = np.frombuffer(b"".join(x[6] for x in held), ">u4").reshape(-1, least.values).astype(np.uint32)
    joined = np.arange(len(node))
    for i in np.flatnonzero(asks).tolist():
        near = _asked(i, node, rest, member) & (root != root[i]) & (joined != joined[i])
        at = np.flatnonzero(near & _sizes_fit(size, size[i], least.percent))
        if len(at):
            at = at[(values[at] == values[i]).sum(axis=1) >= least.likely]
        while len(at):
            out_u.append(int(node[i]))
            out_v.append(int(node[at[0]]))
            joined[joined == joined[at[0]]] = joined[i]
            at = at[joined[at] != joined[i]]


def _asked(i: int, node: np.ndarray, rest: np.ndarray, member: np.ndarray) -> np.ndarray:
    """Whom node ``i`` asks in its part: members of the largest component, and greater ones."""
    return member & (~rest | (node > node[i]))


def _sizes_fit(sizes: np.ndarray, size: int, percent: int) -> np.ndarray:
    """Whether sets of these sizes can be similar enough."""
    return (100 * sizes >= percent * size) & (100 * size >= percent * sizes)


def remaining(nodes: DataFrame, found: DataFrame, least: Limits) -> DataFrame:
    """u, v: spanning forests of the likely pairs of every region with several components.

    ``found``: node and root so far.
    """
    rooted = nodes.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = regions(rooted, least).select("tree", "region", "node", "root")
    members = materialise(paired(placed, ["tree", "region"], CROWDED), "open-regions")
    return (
        members.join(nodes, "node")
        .select(
            "tree", "region", "part", "node", "root", "n_shingles", "rest", "member", "asks", "signature"
        )
        .repartition("tree", "region", "part")
        .sortWithinPartitions("tree", "region", "part", "node")
        .mapInArrow(lambda parts: _likely_pairs(parts, least), "u long, v long")
    )


def _confirm(parts: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for part in parts:
        u, v = [], []
        for a, b, x, y in zip(*(c.to_pylist() for c in part.columns)):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * both >= percent * (len(x) + len(y) - both):
                u.append(a)
                v.append(b)
        yield _pairs(u, v)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole shingle sets are similar enough."""
    pairs = pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    mine = sets.select(F.col("node").alias("u"), F.col("hashes").alias("mine"))
    theirs = sets.select(F.col("node").alias("v"), F.col("hashes").alias("theirs"))
    both = pairs.join(mine, "u").join(theirs, "v").select("u", "v", "mine", "theirs")
    return both.mapInArrow(lambda parts: _confirm(parts, percent), "u long, v long")


def _exact(parts: Iterator[pa.RecordBatch], least: Limits) -> Iterator[pa.RecordBatch]:
    """Per part of a cluster (rows arrive sorted): links between components."""
    held: list[tuple] = []
    u: list[int] = []
    v: list[int] = []
    last = None
    for batch in parts:
        for cluster, part, *row, hashes in zip(*(c.to_pylist() for c in batch.columns)):
            if (cluster, part) != last:
                _link(held, least, u, v)
                held, last = [], (cluster, part)
            held.append((*row, np.frombuffer(hashes, np.uint64)))
        if len(u) > 10_000:
            yield _pairs(u, v)
    _link(held, least, u, v)
    yield _pairs(u, v)


def _link(held: list[tuple], least: Limits, out_u: list[int], out_v: list[int]) -> None:
    if len(held) < 2:
        return
    node = np.array([x[0] for x in held], np.int64)
    _, joined = np.unique([x[1] for x in held], return_inverse=True)
    rest, member, asks = (np.array(x, bool) for x in list(zip(*held))[2:5])
    values = np.frombuffer(b"".join(x[5] for x in held), ">u4").reshape(-1, least.values).astype(np.uint32)
    size = np.array([len(x[6]) for x in held])
    ends = np.cumsum(size)
    distinct, flat = np.unique(np.concatenate([x[6] for x in held]), return_inverse=True)
    mark = np.zeros(len(distinct), bool)
    for i in np.flatnonzero(asks).tolist():
        near = _asked(i, node, rest, member) & (joined != joined[i]) & _sizes_fit(size, size[i], least.percent)
        at = np.flatnonzero(near)
        if len(at):
            at = at[(values[at] == values[i]).sum(axis=1) >= least.likely]
        if not len(at):
            continue
        mine = flat[ends[i] - size[i] : ends[i]]
        mark[mine] = True
        for j in at.tolist():
            if joined[j] != joined[i]:
                both = int(mark[flat[ends[j] - size[j] : ends[j]]].sum())
                if 100 * both >= least.percent * (size[i] + size[j] - both):
                    joined[joined == joined[j]] = joined[i]
                    out_u.append(int(node[i]))
                    out_v.append(int(node[j]))
        mark[mine] = False


def cluster_links(
    likely: DataFrame, nodes: DataFrame, found: DataFrame, sets: DataFrame, least: Limits
) -> DataFrame:
    """u, v: confirmed links that connect the components within each likely cluster."""
    members = (
        components(likely)
        .withColumnRenamed("root", "cluster")
        .join(found, "node", "left")
        .select("cluster", "node", F.coalesce("root", "node").alias("root"))
    )
    return (
        paired(members, ["cluster"], BLOCK)
        .join(nodes.select("node", "signature"), "node")
        .join(sets, "node")
        .select("cluster", "part", "node", "root", "rest", "member", "asks", "signature", "hashes")
        .repartition("cluster", "part")
        .sortWithinPartitions("cluster", "part", "node")
        .mapInArrow(lambda parts: _exact(parts, least), "u long, v long")
    )


def _grouped(docs: DataFrame, percent: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, root and component_id of every row of ``docs``."""
    least = limits(percent)
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash")
    )
    signed = materialise(texts.mapInArrow(lambda parts: _sign(parts, least.values), _SIGNED), "signatures")
    nodes = (
        signed.where("n_shingles > 0")
        .groupBy("key")
        .agg(
            F.min("doc_id").alias("least_id"),
            F.max("n_shingles").alias("n_shingles"),
            F.max("signature").alias("signature"),
        )
        .withColumn("node", F.monotonically_increasing_id())
    )
    nodes = materialise(nodes, "nodes")
    rooted = _linked(texts, nodes, least)
    named = nodes.join(rooted, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of_key = named.join(ids, "root").select("key", "root", "component_id")
    return signed.drop("signature").join(of_key, "key", "left").drop("key")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id and kept.

    Linked are texts whose shingle sets have ``percent`` of their union in common.

    component_id is the smallest doc_id that links lead to, its own included; NULL ids are
    passed over, and a component of NULL ids has none. ``kept`` is doc_id = component_id,
    false for NULL; rows that repeat a kept doc_id are all kept. A NULL or empty text, or
    one without words, has no shingles and no links. Equal shingle sets are linked. Other
    columns are not read; an empty table gives an empty result.
    """
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return (
        _grouped(docs, percent)
        .select("doc_id", "n_shingles", own.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    )


def one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` without shingles, and one row of each component of the others.

    That is the row of the smallest doc_id (NULL last), then of the smallest text hash; of
    rows that agree in doc_id and text any one.
    """
    (hashed,) = fresh(docs, "_text_hash")
    grouped = materialise(_grouped(docs, percent).where("n_shingles > 0"), "groups")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    kept = grouped.groupBy("root").agg(F.min(first).alias("first"))
    gone = (
        grouped.join(kept, "root")
        .where(~first.eqNullSafe(F.col("first")))
        .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
        .distinct()
    )
    gone = materialise(gone, "gone")
    if gone.count() <= MAX_BROADCAST:
        gone = F.broadcast(gone)
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col(hashed).eqNullSafe(F.col("_hash"))
    left = docs.withColumn(hashed, F.xxhash64("text")).join(gone, same, "left_anti")
    copies = (
        grouped.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
        .count()
        .where("count > 1")
        .drop("count")
    )
    copies = materialise(copies, "copies")
    if not copies.isEmpty():
        repeated = left.join(copies, same, "left_semi").dropDuplicates(["doc_id", hashed])
        left = left.join(copies, same, "left_anti").unionByName(repeated)
    return left.drop(hashed)


def _linked(texts: DataFrame, nodes: DataFrame, least: Limits) -> DataFrame:
    """node and root of every node with a confirmed link."""
    placed = regions(nodes.select("node", "signature"), least).select("node", "tree", "region")
    shared = placed.groupBy("tree", "region").agg(F.count("*").alias("n")).where("n > 1")
    wanted = placed.join(shared.drop("n"), ["tree", "region"], "left_semi").select("node").distinct()
    wanted = materialise(nodes.join(wanted, "node", "left_semi"), "wanted")
    few = wanted.count() <= MAX_BROADCAST
    ids = wanted.select("node", "key", F.col("least_id").alias("doc_id"))
    asked = ids.select(F.col("doc_id").alias("asked")).distinct()
    keys = ids.select("key", "node")
    if few:
        asked, keys = F.broadcast(asked), F.broadcast(keys)
    of = F.col("doc_id").eqNullSafe(F.col("asked"))
    sets = (
        texts.select("doc_id", "text")
        .join(asked, of, "left_semi")
        .select("text")
        .mapInArrow(_sets, "key binary, hashes binary")
        .join(keys, "key")
        .groupBy("node")
        .agg(F.max("hashes").alias("hashes"))
    )
    sets = materialise(sets, "shingle-sets")
    links = materialise(confirmed(neighbours(wanted, least), sets, least.percent), "links")
    found = components(links)
    likely = remaining(wanted.drop("least_id", "key"), found, least)
    more = cluster_links(likely, wanted, found, sets, least)
    return components(links.unionByName(more))


def query(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), PERCENT)
