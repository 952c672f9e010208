"""Which source files have landed: a ledger of files, against which a landing is planned.

A batch lands the files that the ledger does not hold, reconciles its rows file by file
with a scan of its own, and adds the files to the ledger. Landing the same folder again adds
nothing. A file that changed after it landed stops the batch: its rows are published.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftledger.schemas import LANDED_FILES
from siftledger.sources import delimited


class ChangedFile(ValueError):
    """A file that has landed is not the same any more."""


def listing(spark: SparkSession, source: str) -> DataFrame:
    """path, name, size and modified_at of every file below ``source``; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source)
    return files.select(
        plain(F.col("path")).alias("path"),
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified_at"),
    )


def plain(path: Column) -> Column:
    """A path in one spelling: Spark gives local files one slash here and three there."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def not_landed(listed: DataFrame, landed: DataFrame) -> DataFrame:
    """Listed files that the ledger does not hold; raises if one of its files changed."""
    known = landed.select("path", F.col("size").alias("_size"), F.col("modified_at").alias("_at"))
    found = listed.join(known, "path", "left")
    changed = found.where("_size <> size OR _at <> modified_at").select("path").take(10)
    if changed:
        raise ChangedFile("changed after landing: " + ", ".join(r["path"] for r in changed))
    return found.where("_at IS NULL").select(*listed.columns)


def land_new(
    spark: SparkSession, source: str, landed: DataFrame, batch: str, run_ts: datetime
) -> tuple[DataFrame, DataFrame] | None:
    """Rows of the files that have not landed, and their ledger rows; None if there are none.

    The list of new paths is on the driver, as Spark's own file listing is.
    """
    files = not_landed(listing(spark, source), landed)
    paths = [r["path"] for r in files.select("path").orderBy("path").collect()]
    if not paths:
        return None
    delimited.validate_header(spark, paths[0])
    counted = delimited.count_rows_by_file(spark, paths)
    ledger = files.join(counted.withColumn("path", plain(F.col("path"))), "path", "left").select(
        "path",
        "name",
        "size",
        "modified_at",
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        F.lit(batch).alias("batch"),
    )
    return delimited.read_source(spark, paths, run_ts), ledger.select(*LANDED_FILES.schema.names)


def differences(landed_rows: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files whose landed rows are not the counted ones: name, n_rows and n_landed.

    Files of one base name, in several folders, are compared together.
    """
    expected = ledger.groupBy("name").agg(F.sum("n_rows").alias("n_rows"))
    found = landed_rows.groupBy(F.col("_source_file").alias("name")).agg(
        F.count("*").alias("n_landed")
    )
    both = expected.join(found, "name", "full").na.fill(0, ["n_rows", "n_landed"])
    return both.where("n_rows <> n_landed")


def reconcile(landed_rows: DataFrame, ledger: DataFrame) -> None:
    """Raise unless every file's rows have landed, all of them and no others."""
    wrong = differences(landed_rows, ledger).orderBy("name").take(10)
    if wrong:
        raise delimited.ReconciliationError(
            "; ".join(f"{r['name']}: {r['n_rows']} counted, {r['n_landed']} landed" for r in wrong)
        )
