"""Snapshots: one manifest names the files of every table, and is replaced in one step.

A commit appends one Parquet file with a row per table part to ``<root>/snapshots``. The
file appears by a single rename, so a reader finds the whole new snapshot or the one before,
for all tables alike. An open snapshot is a list of paths: publishing cannot change what its
reader sees, and its files stay until :meth:`Snapshots.expire` lets go of it.

Every part keeps its number of rows and a fingerprint that does not depend on their order,
so stored files can be verified later.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import astuple, dataclass
from datetime import datetime
from decimal import Decimal

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftledger.schemas import Relation
from siftledger.session import remove

MANIFEST = (
    "snapshot long, committed_at timestamp, run_id string, version string, table string, "
    "part string, batch string, path string, n_rows long, fingerprint decimal(38, 0)"
)
# What a table's rows add up to; rows in another order give the same.
MEASURED = ("n_rows", "fingerprint")


class StaleBase(RuntimeError):
    """Another snapshot was committed since the one this work is based on."""


@dataclass(frozen=True)
class Part:
    """Files of a table: those of one partition value (``part`` None: not divided), written
    for one batch of source rows."""

    table: str
    part: str | None
    batch: str
    path: str
    n_rows: int
    fingerprint: Decimal


def measures(columns: Sequence[str]) -> list[Column]:
    """Number and order-free fingerprint of rows, as aggregates."""
    hashed = F.xxhash64(*columns).cast("decimal(20, 0)")
    return [
        F.count("*").alias("n_rows"),
        F.coalesce(F.sum(hashed), F.lit(0)).cast("decimal(38, 0)").alias("fingerprint"),
    ]


def read_parts(
    spark: SparkSession, root: str, relation: Relation, parts: Iterable[Part]
) -> DataFrame:
    """The rows of ``parts``: declared columns and partition column, typed as declared."""
    paths = [f"{root}/{p.path}" for p in parts]
    schema = relation.stored_schema
    if not paths:
        # Known to be empty when planned, so that no task looks for rows.
        none = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
        return spark.range(1).where("false").select(*none)
    base = f"{root}/{relation.namespace}/{relation.name}"
    return spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.names)


@dataclass(frozen=True)
class Snapshot:
    """What was published under one number."""

    spark: SparkSession
    root: str
    number: int
    run_id: str
    version: str
    parts: tuple[Part, ...]

    def parts_of(self, relation: Relation) -> list[Part]:
        return [p for p in self.parts if p.table == relation.full_name]

    def read(self, relation: Relation, parts: Iterable[Part] | None = None) -> DataFrame:
        """The relation with its declared columns and its partition column.

        A filter on the partition column leaves out whole parts. ``parts`` restricts what
        is read, to those of :meth:`parts_of`.
        """
        return read_parts(
            self.spark, self.root, relation, self.parts_of(relation) if parts is None else parts
        )

    def files(self, relation: Relation) -> DataFrame:
        """The relation as a plain scan, with Spark's ``_metadata`` of each row's file."""
        paths = [f"{self.root}/{p.path}" for p in self.parts_of(relation)]
        return self.spark.read.schema(relation.schema).parquet(*paths)

    def measured(self, relation: Relation) -> DataFrame:
        """part, n_rows and fingerprint of what is stored now."""
        rows = self.read(relation)
        part = F.lit(None) if relation.partition is None else F.col(relation.partition.name)
        grouped = rows.groupBy(part.cast("string").alias("part"))
        return grouped.agg(*measures(relation.schema.names))

    def expected(self) -> DataFrame:
        """table, part, n_rows and fingerprint as committed."""
        rows = [(p.table, p.part, p.n_rows, p.fingerprint) for p in self.parts]
        return self.spark.createDataFrame(
            rows, "table string, part string, n_rows long, fingerprint decimal(38, 0)"
        )


class Snapshots:
    """The snapshots of one warehouse folder. One publisher commits at a time."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.folder = f"{self.root}/snapshots"

    def manifest(self) -> DataFrame | None:
        """Every row of every kept snapshot; None before the first."""
        try:
            return self.spark.read.schema(MANIFEST).parquet(self.folder)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def latest(self, run_id: str | None = None) -> int | None:
        """The highest number, or the highest of a run."""
        found = self.manifest()
        if found is None:
            return None
        of_run = found if run_id is None else found.where(F.col("run_id") == run_id)
        return of_run.agg(F.max("snapshot")).first()[0]

    def open(self, number: int | None = None, run_id: str | None = None) -> Snapshot:
        """A snapshot by number, the last of a run, or the last of all."""
        chosen = self.latest(run_id) if number is None else number
        rows = [] if chosen is None else self.manifest().where(F.col("snapshot") == chosen).collect()
        if not rows:
            asked = f" for {run_id}" if run_id else "" if number is None else f" as {number}"
            raise FileNotFoundError(f"nothing published under {self.root}{asked}")
        parts = tuple(
            Part(*(r[name] for name in ("table", "part", "batch", "path", *MEASURED))) for r in rows
        )
        return Snapshot(self.spark, self.root, chosen, rows[0]["run_id"], rows[0]["version"], parts)

    def last(self) -> Snapshot:
        """The last snapshot; before the first, one with number 0 and no parts."""
        number = self.latest()
        return Snapshot(self.spark, self.root, 0, "", "", ()) if number is None else self.open(number)

    def commit(
        self,
        parts: Sequence[Part],
        run_id: str,
        version: str,
        committed_at: datetime,
        base: int | None = None,
    ) -> Snapshot:
        """Publish ``parts`` as the next snapshot.

        ``base``: the snapshot that parts were taken over from. If it is not the last one
        any more, the commit is refused instead of undoing another's.
        """
        last = self.latest()
        if base is not None and base != (last or 0):
            raise StaleBase(f"based on snapshot {base}, but {last} is published under {self.root}")
        number = (last or 0) + 1
        rows = [
            (number, committed_at, run_id, version, *astuple(p)) for p in parts
        ]
        manifest = self.spark.createDataFrame(rows, MANIFEST).coalesce(1)
        manifest.write.mode("append").parquet(self.folder)  # one file: one rename
        return Snapshot(self.spark, self.root, number, run_id, version, tuple(parts))

    def expire(self, keep: int) -> tuple[list[int], list[str]]:
        """Let go of all but the last ``keep`` snapshots; their numbers and the paths removed.

        Files that a kept snapshot names stay, whoever wrote them. Manifests go first, so
        that no new reader finds a snapshot whose files are about to go.
        """
        if keep < 1:
            raise ValueError("at least one snapshot is kept")
        found = self.manifest()
        if found is None:
            return [], []
        rows = found.select("snapshot", "path", F.col("_metadata.file_path").alias("file")).collect()
        numbers = sorted({r["snapshot"] for r in rows})
        old = set(numbers[:-keep])
        kept = {r["path"] for r in rows if r["snapshot"] not in old}
        gone = sorted({r["path"] for r in rows if r["snapshot"] in old} - kept)
        remove(self.spark, *sorted({r["file"] for r in rows if r["snapshot"] in old}))
        remove(self.spark, *(f"{self.root}/{path}" for path in gone))
        return sorted(old), gone

