"""Published snapshots in the session's catalog: typed, partitioned, switched in one step.

For each relation an external table ``<name>__files`` holds the declared columns with their
comments, partitioned by snapshot number, piece and the relation's partition column; publishing
adds the new snapshot's files as partitions, which nobody reads yet. The relation itself is
a view on the rows of the number that the view ``analytics.current_snapshot`` gives. That
view is one row, so its number becomes a constant of every plan, prunes partitions, and
is looked up once per query; replacing it moves all relations at once. Older snapshots can be read
from the tables by number until they expire.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftledger.functions.dates import month_start
from siftledger.schemas import NAMESPACES, Relation
from siftledger.sinks.snapshots import Snapshot

CURRENT = "analytics.current_snapshot"
CONCURRENT_STATEMENTS = 8


class Catalog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def show(
        self, snapshot: Snapshot, relations: Sequence[Relation], queries: Mapping[str, str] = {}
    ) -> None:
        """Make ``snapshot`` the current one.

        ``queries`` are views defined by SQL over relations. A catalog that shows another
        folder lets go of its tables first.
        """
        self.namespaces()
        shown = self.current()
        if shown is not None and shown[1] != self.root:
            self._forget()
            shown = None
        self._each(lambda r: self._register(snapshot, r), relations)
        if shown is None:  # the views below need it; nothing is visible before them
            self._switch(snapshot.number)
        self._each(self._view, relations)
        for name, query in queries.items():
            self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")
        self._switch(snapshot.number)

    def namespaces(self) -> None:
        for name in NAMESPACES:
            location = text(f"{self.root}/{name}")
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION {location}")

    def show_log(self, relation: Relation, location: str) -> None:
        """A view on files that grow from run to run, outside the snapshots."""
        self._define(relation, relation.schema.names, f"parquet.`{location}`")

    def current(self) -> tuple[int, str] | None:
        """Number and folder of the snapshot shown now."""
        if not self.spark.catalog.tableExists(CURRENT):
            return None
        return tuple(self.spark.table(CURRENT).first())

    def forget(self, numbers: Iterable[int], relations: Sequence[Relation]) -> None:
        """Let go of expired snapshots; files are not touched."""
        gone = {str(n) for n in numbers}
        for relation in relations if gone else ():
            if not self.spark.catalog.tableExists(files_of(relation)):
                continue
            # A line like snapshot=1/piece=0/month=2024-01-01 for every folder of a snapshot.
            lines = self.spark.sql(f"SHOW PARTITIONS {files_of(relation)}").collect()
            specs = []
            for line in lines:
                number, piece, *value = [key.split("=", 1)[1] for key in line[0].split("/")]
                if number in gone:
                    specs.append(f"PARTITION ({_spec(relation, int(number), int(piece), *value)})")
            if specs:
                self.spark.sql(f"ALTER TABLE {files_of(relation)} DROP IF EXISTS {', '.join(specs)}")

    def _forget(self) -> None:
        """Let go of every table of another folder; its files stay."""
        self.spark.sql(f"DROP VIEW {CURRENT}")
        for name in NAMESPACES:
            for row in self.spark.sql(f"SHOW TABLES IN {name} LIKE '*__files'").collect():
                self.spark.sql(f"DROP TABLE IF EXISTS {name}.{row['tableName']}")
                self.spark.sql(f"DROP VIEW IF EXISTS {name}.{row['tableName'].removesuffix('__files')}")

    def _switch(self, number: int) -> None:
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {CURRENT} AS "
            f"SELECT CAST({number} AS BIGINT) AS number, {text(self.root)} AS root"
        )

    def _register(self, snapshot: Snapshot, relation: Relation) -> None:
        keys = ["snapshot", "piece"] + ([relation.partition.name] if relation.partition else [])
        columns = [f for f in relation.stored_schema if f.name not in keys]
        declared = [f"`{f.name}` {f.dataType.simpleString()}{_comment(f)}" for f in columns]
        declared.append("snapshot BIGINT COMMENT 'Number of the snapshot.'")
        declared.append("piece INT COMMENT 'Number of the folder within the snapshot.'")
        if relation.partition:
            part = relation.partition
            declared.append(f"`{part.name}` {part.dataType.simpleString()}{_comment(part)}")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {files_of(relation)} ({', '.join(declared)}) USING parquet "
            f"PARTITIONED BY ({', '.join(keys)}) COMMENT {text(relation.comment)} "
            f"LOCATION {text(f'{self.root}/{relation.namespace}/{relation.name}')}"
        )
        added = []
        for piece, part in enumerate(snapshot.parts_of(relation)):
            spec = _spec(relation, snapshot.number, piece, part.part)
            added.append(f"PARTITION ({spec}) LOCATION {text(f'{self.root}/{part.path}')}")
        if added:
            self.spark.sql(f"ALTER TABLE {files_of(relation)} ADD IF NOT EXISTS {' '.join(added)}")

    def _view(self, relation: Relation) -> None:
        rows = f"{files_of(relation)} WHERE snapshot = (SELECT number FROM {CURRENT})"
        self._define(relation, relation.stored_schema.names, rows)

    def _define(self, relation: Relation, columns: Sequence[str], rows: str) -> None:
        fields = {f.name: f for f in relation.stored_schema}
        names = ", ".join(f"`{c}`{_comment(fields[c])}" for c in columns)
        # Files without a declared table give partition values as text, hence the casts.
        values = ", ".join(f"CAST(`{c}` AS {fields[c].dataType.simpleString()})" for c in columns)
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {relation.full_name} ({names}) "
            f"COMMENT {text(relation.comment)} AS SELECT {values} FROM {rows}"
        )

    def _each(self, action, items: Sequence) -> None:
        with ThreadPoolExecutor(CONCURRENT_STATEMENTS) as pool:
            list(pool.map(inheritable_thread_target(self.spark)(action), items))


def files_of(relation: Relation) -> str:
    """The table with the files of every kept snapshot."""
    return f"{relation.namespace}.{relation.name}__files"


def with_calendar(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """The fact with the calendar's columns of its day.

    The months join too: a filter on the calendar then leaves out the other months' files.
    """
    days = calendar.drop("month").withColumn("month", month_start(F.col("date_day")).cast("date"))
    return fact.join(days, ["date_key", "month"])


def _spec(relation: Relation, number: int, piece: int, value: str | None = None) -> str:
    """The partition of a folder, with its value as a literal of its type."""
    spec = f"snapshot = {number}, piece = {piece}"
    if relation.partition is None:
        return spec
    kind = relation.partition.dataType.simpleString()
    literal = {"boolean": value, "date": f"DATE{text(value)}"}.get(kind, text(value))
    return f"{spec}, {relation.partition.name} = {literal}"


def _comment(field) -> str:
    comment = (field.metadata or {}).get("comment")
    return f" COMMENT {text(comment)}" if comment else ""


def text(value: str) -> str:
    """A string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
