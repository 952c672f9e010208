"""Land delimited files as text: verbatim, complete, and reconciled.

Dialect: comma, double quote doubled inside quotes, UTF-8, one header per file. An
unquoted empty field is NULL, a quoted one is the empty string. A row with too few or
too many fields stops the load. Files stay splittable unless ``multi_line`` says that
quoted fields may hold line breaks; without it such a row stops the load as ragged.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftledger.schemas import RAW_COLUMNS, SOURCE_SCHEMA
from siftledger.session import materialise

# NUL cannot occur in text, so no value is mistaken for the NULL marker.
_NULL_MARK = "\u0000"


class ReconciliationError(ValueError):
    """The landed rows are not the rows of the source."""


def _reader(spark: SparkSession, multi_line: bool):
    return (
        spark.read.schema(SOURCE_SCHEMA)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", _NULL_MARK)
        .option("emptyValue", "")
        .option("multiLine", multi_line)
    )


def validate_header(spark: SparkSession, path: str) -> None:
    """Raise unless the source exists and its first record names the expected columns.

    Names are trimmed; order counts. This peeks at one record, to fail before anything
    is scanned. In a folder, :func:`count_data_rows` tests the header of each file.
    """
    try:
        first = spark.read.text(path).take(1)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"source not found: {path}") from error
        raise
    if not first:
        raise ValueError(f"source is empty, without a header: {path}")
    found = [name.strip() for name in next(csv.reader([first[0].value]), [])]
    if found != list(RAW_COLUMNS):
        raise ValueError(f"header of {path}: expected {list(RAW_COLUMNS)}, found {found}")


def count_data_rows(spark: SparkSession, path: str, multi_line: bool = False) -> int:
    """Records in the source without the headers, from a scan of its own.

    The scan also stops at any file whose header, names trimmed, is not the expected
    one. It keeps ragged rows, so it does not share the landing's way of failing.
    """
    with _exact_names(spark):
        return _counting_scan(spark, path, multi_line).count()


def count_rows_by_file(
    spark: SparkSession, paths: Sequence[str], multi_line: bool = False
) -> DataFrame:
    """path and n_rows of every file with records, like :func:`count_data_rows`; stored."""
    with _exact_names(spark):
        scan = _counting_scan(spark, list(paths), multi_line)
        by_file = scan.groupBy(decoded(F.col("_metadata.file_path")).alias("path"))
        return materialise(by_file.agg(F.count("*").alias("n_rows")), "rows-by-file")


def decoded(name: Column) -> Column:
    """A file name or path as it is; Spark's metadata give it percent-encoded."""
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def _counting_scan(spark: SparkSession, path: str | list[str], multi_line: bool) -> DataFrame:
    return (
        _reader(spark, multi_line)
        .option("mode", "PERMISSIVE")
        .option("enforceSchema", False)
        .option("columnPruning", False)  # the header is compared with all columns
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .csv(path)
    )


@contextmanager
def _exact_names(spark: SparkSession) -> Iterator[None]:
    """Within the block, headers are compared letter for letter."""
    exact = "spark.sql.caseSensitive"
    before = spark.conf.get(exact)
    spark.conf.set(exact, "true")
    try:
        yield
    finally:
        spark.conf.set(exact, before)


def read_source(
    spark: SparkSession, path: str | list[str], run_ts: datetime, multi_line: bool = False
) -> DataFrame:
    """The source as text columns, with the load time and each row's file name.

    ``run_ts`` is a literal: evaluating the frame again cannot change it.
    """
    return (
        _reader(spark, multi_line)
        .option("mode", "FAILFAST")
        .csv(path)
        .select(
            *RAW_COLUMNS,
            F.lit(run_ts).cast("timestamp").alias("_ingested_at"),
            decoded(F.col("_metadata.file_name")).alias("_source_file"),
        )
    )


def count_rows(table: DataFrame) -> int:
    """Rows of a landed table; Parquet answers from its footers."""
    return table.count()


def reconcile(expected: int, landed: DataFrame) -> int:
    """Raise unless ``landed`` holds exactly the ``expected`` number of rows."""
    loaded = count_rows(landed)
    if loaded != expected:
        raise ReconciliationError(f"source has {expected} data rows, landed {loaded}")
    return loaded
