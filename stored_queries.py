"""Queries over what is stored and published: batches, snapshots, upserts, the file ledger.

Each builds a warehouse from the whole feed in the shared folder. The three batches are
added once per folder and application; several queries read the snapshots they leave.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftledger import schemas
from siftledger.plans import aggregates, batches, marts, staging
from siftledger.plans.run import PUBLISHED, VIEWS, Options, RunReport, run
from siftledger.plans.verify import accepted, verify_files
from siftledger.schemas import FACT, ID_INDEX, LANDED_FILES, RAW, RAW_COLUMNS
from siftledger.session import scratch_dir, shuffles_removed
from siftledger.sinks.catalog import with_calendar
from siftledger.sinks.snapshots import Snapshot, Snapshots
from siftledger.sinks.warehouse import Warehouse
from siftledger.sources.derived import INGESTED_AT, INVOCATION_ID, dirty_feed

BATCHES = (1, 2, 3)
OPTIONS = Options(spine=("1990-01-01", "2031-01-01"), index_buckets=8, strict=False)
VERIFIED = (FACT, schemas.QUARANTINE, schemas.DIM_PRODUCT, schemas.DIM_CUSTOMER)

_added: dict[tuple[str, str], Snapshot] = {}
_run: dict[tuple[str, str], RunReport] = {}


def new_root(spark: SparkSession) -> str:
    application = spark.sparkContext.applicationId
    return f"{scratch_dir(spark)}/{application}/warehouse-{uuid.uuid4().hex}"


def after_batches(spark: SparkSession, folder: str) -> Snapshot:
    """The snapshot after the three batches of the feed, each landed from files, twice."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _added:
        root, source = new_root(spark), new_root(spark)
        feed = dirty_feed(spark, folder, batched=True)
        run_ts = datetime.fromisoformat(f"{INGESTED_AT}+00:00")
        for number in BATCHES:
            with shuffles_removed(spark):
                write_csv(feed.where(F.col("batch") == number), f"{source}/{number}", "gzip")
            for again in ("", "-again"):  # the second finds no new file
                name = f"batch-{number}{again}"
                snapshot = batches.land_batch(spark, source, root, name, run_ts, OPTIONS)
        _added[key] = snapshot
    return _added[key]


def write_csv(feed: DataFrame, target: str, codec: str = "none") -> None:
    """Write a feed's source columns as delimited files, blanks and quotes intact."""
    (
        feed.select(*RAW_COLUMNS)
        .write.option("header", True)
        .option("compression", codec)
        .option("escape", '"')
        .option("emptyValue", '""')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(target)
    )


def _relation(relation: schemas.Relation):
    def read(spark: SparkSession, folder: str) -> DataFrame:
        rows = after_batches(spark, folder).read(relation).select(*relation.schema.names)
        if "dq_reasons" in rows.columns:
            rows = rows.withColumn("dq_reasons", F.array_join("dq_reasons", "|"))
        return rows

    return read


def batches_as_of(spark: SparkSession, folder: str) -> DataFrame:
    """Fact and quarantine as each snapshot has them."""
    last = after_batches(spark, folder)
    found = None
    for number in BATCHES:
        snapshot = Snapshots(spark, last.root).open(number)
        fact = snapshot.read(FACT).agg(
            F.count("*").alias("n_fact"), F.sum("total_amount").alias("total_amount")
        )
        rejected = snapshot.read(schemas.QUARANTINE).agg(F.count("*").alias("n")).scalar()
        row = fact.select(
            F.lit(number).alias("snapshot"), "n_fact", rejected.alias("n_quarantined"), "total_amount"
        )
        found = row if found is None else found.unionByName(row)
    return found


def distinct_by_month(spark: SparkSession, folder: str) -> DataFrame:
    ids = after_batches(spark, folder).read(schemas.MONTHLY_IDS)
    return aggregates.distinct_over(ids.withColumnRenamed("month", "_month"), F.col("_month").alias("month"))


def distinct_by_period(spark: SparkSession, folder: str) -> DataFrame:
    """Every year, every quarter of a year, and all time, from the months' bitmaps."""
    ids = after_batches(spark, folder).read(schemas.MONTHLY_IDS)
    year = F.year("month").cast("string")
    quarter = F.concat(year, F.lit("-Q"), F.quarter("month").cast("string"))
    periods = F.explode(F.array(F.lit("all"), year, quarter)).alias("period")
    return aggregates.distinct_over(ids, periods)


def snapshot_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows committed and rows found in every part of four tables."""
    return verify_files(after_batches(spark, folder), VERIFIED)


def snapshot_acceptance(spark: SparkSession, folder: str) -> DataFrame:
    return accepted(after_batches(spark, folder))


def catalog_calendar(spark: SparkSession, folder: str) -> DataFrame:
    """Sales of every May, from the published tables; other months' files are not read."""
    snapshot = after_batches(spark, folder)
    warehouse = Warehouse(spark, snapshot.root, snapshot.run_id, snapshot.version)
    warehouse.catalog.show(snapshot, batches.BATCHED)
    days = spark.table("analytics.dim_date").where("month_name = 'May'")
    sales = with_calendar(spark.table("analytics.fct_transactions"), days)
    return sales.groupBy("year").agg(
        F.count("*").alias("n"), F.sum("total_amount").alias("total_amount")
    )


def upsert_fact(spark: SparkSession, folder: str) -> DataFrame:
    """The fact after two changes of each row: repeats, other values, other months, deletions."""
    root, raw = new_root(spark), dirty_feed(spark, folder)
    fact = marts.fct_transactions(marts.valid_transactions(staging.staged(raw)))
    warehouse = Warehouse(spark, root, "all")
    warehouse.store(FACT, fact)
    base = warehouse.publish([FACT], {})
    stored = base.read(FACT).select(*FACT.schema.names)
    later = F.date_add("transaction_date", 40)
    moved = F.col("transaction_id") % 3 == 1
    first = stored.withColumns(
        {
            "transaction_date": F.when(moved, later).otherwise(F.col("transaction_date")),
            "date_key": F.when(moved, F.date_format(later, "yyyyMMdd").cast("int")).otherwise(
                F.col("date_key")
            ),
            "_deleted": F.lit(False),
            "_order": F.lit(1),
        }
    )
    second = stored.where("transaction_id % 5 < 2").withColumns(
        {
            "missing_customer": F.lit(True),
            "_deleted": F.col("transaction_id") % 5 == 0,
            "_order": F.lit(2),
        }
    )
    # Only half of the months are touched: changes concern transactions of odd months.
    changes = first.unionByName(second)
    odd = stored.where("month(transaction_date) % 2 = 1").select("transaction_id")
    again = Warehouse(spark, root, "changes")
    again.upsert(FACT, changes.join(odd, "transaction_id", "left_semi"), base)
    return again.publish([FACT], {}, base).read(FACT).select(*FACT.schema.names)


def ledger_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Per batch: records counted in its files, rows landed, and files in which they differ."""
    snapshot = after_batches(spark, folder)
    landed = snapshot.files(RAW).select(
        F.regexp_extract(F.col("_metadata.file_path"), "/run=([^/]*)/", 1).alias("batch"),
        F.col("_source_file").alias("name"),
    )
    landed = landed.groupBy("batch", "name").agg(F.count("*").alias("n_landed"))
    files = snapshot.read(LANDED_FILES).join(landed, ["batch", "name"], "full")
    return (
        files.na.fill(0, ["n_rows", "n_landed"])
        .groupBy("batch")
        .agg(
            F.sum("n_rows").alias("n_rows"),
            F.sum("n_landed").alias("n_landed"),
            F.count_if(F.col("n_rows") != F.col("n_landed")).alias("n_different"),
        )
    )


def after_run(spark: SparkSession, folder: str) -> RunReport:
    """A whole run over the feed's files, repeated under its run id."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _run:
        root, source = new_root(spark), new_root(spark)
        with shuffles_removed(spark):
            write_csv(dirty_feed(spark, folder), source, "gzip")
        run_ts = datetime.fromisoformat(f"{INGESTED_AT}+00:00")
        for _ in range(2):
            _run[key] = run(spark, source, root, INVOCATION_ID, run_ts, OPTIONS)
    return _run[key]


def run_history(spark: SparkSession, folder: str) -> DataFrame:
    """The history after both: a repeated run adds no row."""
    return after_run(spark, folder).relations[schemas.RUN_AUDIT.name]


def run_stored_failures(spark: SparkSession, folder: str) -> DataFrame:
    """The failing rows that the run has stored for the test on quarantined rows."""
    path = after_run(spark, folder).warehouse.path("dq_audit", "quarantine_within_threshold")
    return spark.read.parquet(path).withColumn("dq_reasons", F.array_join("dq_reasons", "|"))


def run_check_results(spark: SparkSession, folder: str) -> DataFrame:
    """Results of the declared tests, as stored; row tests were counted while writing."""
    path = after_run(spark, folder).warehouse.path("dq_audit", "check_results")
    return spark.read.parquet(path).where("check LIKE 'not_null_fct%' OR check LIKE 'unique%' OR failures > 0")


def run_alias_views(spark: SparkSession, folder: str) -> DataFrame:
    """Rows behind the views defined over published relations."""
    snapshot = Snapshots(spark, after_run(spark, folder).warehouse.root).open()
    shown = Warehouse(spark, snapshot.root, snapshot.run_id, snapshot.version)
    shown.catalog.show(snapshot, PUBLISHED, VIEWS)
    found = None
    for name in VIEWS:
        count = spark.table(name).agg(F.lit(name).alias("view"), F.count("*").alias("n"))
        found = count if found is None else found.unionByName(count)
    return found


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "batches_fact": _relation(FACT),
        "batches_quarantine": _relation(schemas.QUARANTINE),
        "batches_dim_product": _relation(schemas.DIM_PRODUCT),
        "batches_dim_customer": _relation(schemas.DIM_CUSTOMER),
        "batches_monthly_sales": _relation(schemas.MONTHLY_SALES),
        "batches_sales_by_customer": _relation(schemas.SALES_BY_CUSTOMER),
        "batches_sales_by_product": _relation(schemas.SALES_BY_PRODUCT),
        "batches_completeness": _relation(schemas.COMPLETENESS),
        "batches_id_counts": _relation(ID_INDEX),
        "batches_as_of": batches_as_of,
        "distinct_by_month": distinct_by_month,
        "distinct_by_period": distinct_by_period,
        "snapshot_parts": snapshot_parts,
        "snapshot_acceptance": snapshot_acceptance,
        "catalog_calendar": catalog_calendar,
        "upsert_fact": upsert_fact,
        "ledger_batches": ledger_batches,
        "run_history": run_history,
        "run_stored_failures": run_stored_failures,
        "run_check_results": run_check_results,
        "run_alias_views": run_alias_views,
    }
