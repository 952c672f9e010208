"""Tables under one root folder: written once, measured, published together.

Each attempt at a run writes ``<root>/<namespace>/<table>/run=<run id>/attempt=<id>``,
never over files that exist. Nothing a reader can see changes until
:meth:`Warehouse.publish` commits a snapshot of all tables, so a failed or repeated run
leaves readers undisturbed. Files stay as long as a kept snapshot names them.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftledger.operators import places
from siftledger.plans.quality import not_yet_recorded
from siftledger.schemas import Relation
from siftledger.session import CODEC, materialise
from siftledger.sinks.catalog import Catalog
from siftledger.sinks.snapshots import (
    MEASURED,
    Part,
    Snapshot,
    Snapshots,
    measures,
    read_parts,
)

# Spark's folder for rows without a partition value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, run_id: str, version: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.run_id = run_id
        self.version = version or f"run={run_id}/attempt={uuid.uuid4().hex}"
        self.snapshots = Snapshots(spark, self.root)
        self.catalog = Catalog(spark, self.root)
        # What this attempt has stored, by relation; and numbers counted while writing.
        self.parts: dict[str, list[Part]] = {}
        self.counted: dict[str, int] = {}

    @classmethod
    def published(cls, spark: SparkSession, root: str, run_id: str | None = None) -> Warehouse:
        """The warehouse as of the snapshot published last, or last for ``run_id``."""
        found = Snapshots(spark, root).open(run_id=run_id)
        return cls(spark, root, found.run_id, found.version)

    # Tables of one run

    def path(self, namespace: str, table: str) -> str:
        return f"{self.root}/{namespace}/{table}/{self.version}"

    def write(
        self, df: DataFrame, namespace: str, table: str, partition_by: Sequence[str] = ()
    ) -> DataFrame:
        """Write this version of a table and return it as stored.

        Rows are not sorted: order in a table is no guarantee, readers sort.
        """
        df.write.partitionBy(*partition_by).parquet(self.path(namespace, table), compression=CODEC)
        return self.read(namespace, table, df.schema)

    def read(self, namespace: str, table: str, schema: T.StructType) -> DataFrame:
        stored = self.spark.read.schema(schema).parquet(self.path(namespace, table))
        return stored.select(*schema.names)

    def store(
        self,
        relation: Relation,
        df: DataFrame,
        counted: Mapping[str, Column] | None = None,
        kept: Sequence[Part] = (),
    ) -> DataFrame:
        """Write rows of a relation and return its declared columns as they are then.

        Rows, fingerprint and the ``counted`` aggregates (by name, into :attr:`counted`)
        are observed on the rows as they are written, without a scan of their own. Only
        parts that are not two are measured afterwards, which also reads them back.
        ``kept`` parts, of an earlier snapshot, belong to the relation besides.
        """
        names, part = relation.schema.names, relation.partition
        target = self.path(relation.namespace, relation.name)
        rows = df
        if relation.partition_sql is not None:
            rows = rows.withColumn(part.name, F.expr(relation.partition_sql))
        rows = rows.select(*relation.stored_schema.names)
        if part is not None and not isinstance(part.dataType, T.BooleanType):
            # Few files a part, large parts in several tasks.
            rows = rows.hint("rebalance", part.name)
        two_parts = part is not None and isinstance(part.dataType, T.BooleanType)
        wanted = {f"_{i}": measure for i, measure in enumerate((counted or {}).values())}
        if two_parts:
            for value in (True, False):
                of_part = F.col(part.name) == value
                for name, measure in zip(MEASURED, _measures_where(of_part, names)):
                    wanted[f"_{name}_{value}"] = measure
        elif part is None:
            wanted |= dict(zip(MEASURED, measures(names)))
        observed = {}
        if wanted:
            observation = Observation()
            rows = rows.observe(observation, *[m.alias(n) for n, m in wanted.items()])
        rows.write.partitionBy(*([part.name] if part else [])).parquet(target, compression=CODEC)
        if wanted:
            observed = observation.get
        self.counted |= {n: observed[f"_{i}"] for i, n in enumerate(counted or {})}
        folder = f"{relation.namespace}/{relation.name}/{self.version}"
        if two_parts:
            measured = [
                (str(v).lower(), *(observed[f"_{m}_{v}"] for m in MEASURED)) for v in (True, False)
            ]
        elif part is None:
            measured = [(None, *(observed[m] for m in MEASURED))]
        else:
            measured = self.measured_parts(relation, target)
        written = [
            Part(
                relation.full_name,
                p,
                self.run_id,
                folder if p is None else f"{folder}/{part.name}={p}",
                n,
                x,
            )
            for p, n, x in measured
            if p is None or n
        ]
        self.parts[relation.full_name] = [*kept, *written]
        return self.current(relation).select(*names)

    def current(self, relation: Relation) -> DataFrame:
        """A relation that this run has stored, with its partition column."""
        return read_parts(self.spark, self.root, relation, self.parts[relation.full_name])

    def added(self, relation: Relation) -> DataFrame:
        """The rows of a relation that this run itself has stored."""
        own = [p for p in self.parts[relation.full_name] if p.batch == self.run_id]
        return read_parts(self.spark, self.root, relation, own).select(*relation.schema.names)

    def note(self, relation: Relation) -> None:
        """Take up a relation that was written at its path by other means."""
        path = self.path(relation.namespace, relation.name)
        stored = self.spark.read.schema(relation.schema).parquet(path)
        measured = stored.agg(*measures(relation.schema.names)).first()
        folder = f"{relation.namespace}/{relation.name}/{self.version}"
        part = Part(relation.full_name, None, self.run_id, folder, *measured)
        self.parts[relation.full_name] = [part]

    def upsert(
        self,
        relation: Relation,
        changes: DataFrame,
        base: Snapshot,
        counted: Mapping[str, Column] | None = None,
        keys_move: bool = True,
        each_once: bool = False,
    ) -> list[str]:
        """Merge ``changes`` into the relation of ``base``; the parts that were written anew.

        ``changes``: the declared columns, ``_deleted`` and ``_order``; see
        :func:`latest_changes`. Only parts that hold a changed key or receive one are read in
        full and written; the others stay as they are. To find the parts that hold one, the
        key column is read, unless ``keys_move`` says that changes name the part of the
        row that they replace or delete. ``each_once``: no key comes twice among the changes,
        received keys are not in ``base``, and the changes are read from stored rows; they are
        then neither grouped nor stored, and only deleted keys are looked for.
        """
        key, part = relation.primary_key, relation.partition
        latest = changes if each_once else materialise(latest_changes(changes, key), "changes", CODEC)
        received = latest.where("NOT _deleted")
        keys = (latest.where("_deleted") if each_once else latest).select(key)
        named = latest if not keys_move else received
        parts_of = named.select(F.expr(relation.partition_sql).alias(part.name))
        if keys_move:
            held = base.read(relation).select(key, part.name).join(keys, key, "left_semi")
            parts_of = parts_of.union(held.select(part.name))
        found = parts_of.distinct().select(F.col(part.name).cast("string")).collect()
        touched = {r[0] for r in found}
        parts = base.parts_of(relation)
        before = base.read(relation, [p for p in parts if p.part in touched])
        before = before.select(*relation.schema.names)
        merged = places.without(before, keys, key) if each_once else before.join(keys, key, "left_anti")
        merged = merged.unionByName(received.select(*relation.schema.names))
        self.store(relation, merged, counted, [p for p in parts if p.part not in touched])
        return sorted(touched)

    def measured_parts(self, relation: Relation, target: str) -> list[tuple]:
        """Part, rows and fingerprint of stored files, from a scan; a row per partition value."""
        stored = self.spark.read.schema(relation.stored_schema).parquet(target)
        value = F.col(relation.partition.name).cast("string")
        by_part = stored.groupBy(F.coalesce(value, F.lit(NO_VALUE)).alias("part"))
        return [tuple(r) for r in by_part.agg(*measures(relation.schema.names)).collect()]

    # Tables that grow from run to run

    def log_path(self, namespace: str, table: str) -> str:
        return "/".join(part for part in (self.root, namespace, table) if part)

    def append_once(self, df: DataFrame, namespace: str, table: str, key: str) -> DataFrame:
        """Append the rows whose ``key`` is not stored yet; return the whole log.

        Repeating a run therefore adds nothing. Runs must not append concurrently.
        """
        logged = self._log(namespace, table, df.schema)
        fresh = df if logged is None else not_yet_recorded(df, logged, key)
        fresh.coalesce(1).write.mode("append").parquet(self.log_path(namespace, table))
        return self._log(namespace, table, df.schema)

    def _log(self, namespace: str, table: str, schema: T.StructType | str) -> DataFrame | None:
        try:
            return self.spark.read.schema(schema).parquet(self.log_path(namespace, table))
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    # Publishing

    def publish(
        self,
        relations: Sequence[Relation],
        queries: Mapping[str, str],
        base: Snapshot | None = None,
    ) -> Snapshot:
        """Commit what was stored as the next snapshot, and show it in the catalog.

        Parts of ``base`` are kept for relations that this run has not stored.
        """
        kept = [p for p in (base.parts if base else ()) if p.table not in self.parts]
        snapshot = self.snapshots.commit(
            kept + [p for parts in self.parts.values() for p in parts],
            self.run_id,
            self.version,
            datetime.now(timezone.utc),
            base.number if base else None,
        )
        self.catalog.show(snapshot, relations, queries)
        return snapshot

    def show_logs(self, logs: Sequence[Relation]) -> None:
        for relation in logs:
            self.catalog.show_log(relation, self.log_path(relation.namespace, relation.name))


def latest_changes(changes: DataFrame, key: str) -> DataFrame:
    """The last change of each key by ``_order``; of two in one place, a deletion, then any.

    A key that comes twice with the same row, or was deleted before it came, is no error.
    """
    columns = [c for c in changes.columns if c not in (key, "_order", "_deleted")]
    change = F.struct("_order", "_deleted", *columns)
    last = changes.groupBy(key).agg(F.max(change).alias("_last"))
    return last.select(key, "_last._deleted", *[f"_last.{c}" for c in columns])


def _measures_where(condition: Column, columns: Sequence[str]) -> list[Column]:
    """The measures of the rows for which ``condition`` holds."""
    hashed = F.when(condition, F.xxhash64(*columns)).cast("decimal(20, 0)")
    return [
        F.count_if(condition),
        F.coalesce(F.sum(hashed), F.lit(0)).cast("decimal(38, 0)"),
    ]
