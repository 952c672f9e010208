"""Batches: new source rows change what is published instead of replacing it.

After any number of batches every mart holds the rows that one run over all their rows
would give. A batch reads its own rows, the rows it takes back, and the parts it touches:

* the id counts are joined by bucket, and say which ids of the batch are repeated and which
  were held by one earlier row until now; those rows are judged again from their raw text;
* the fact is written anew for the months that gain or lose rows, the monthly sales for
  the same months, the customers' sales for the customers of those rows;
* product sums are added to and taken from.

All of it is published as one snapshot, which keeps the untouched parts of the last one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime
from zlib import crc32

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftledger import schemas
from siftledger.operators import key_counts, places
from siftledger.plans import aggregates, checks, marts, quality, staging
from siftledger.plans.run import VIEWS, ContractViolation, Options
from siftledger.schemas import ID_INDEX, LANDED_FILES, PRODUCT_NAMES, PRODUCT_TOTALS
from siftledger.session import CODEC, materialise, release, shuffles_removed
from siftledger.sinks.snapshots import Snapshot, Snapshots, read_parts
from siftledger.sinks.warehouse import Warehouse
from siftledger.sources import ledger

BATCHED = (
    schemas.RAW,
    schemas.DIM_PRODUCT,
    schemas.DIM_CUSTOMER,
    schemas.DIM_DATE,
    schemas.FACT,
    schemas.QUARANTINE,
    schemas.COMPLETENESS,
    schemas.MONTHLY_SALES,
    schemas.MONTHLY_IDS,
    schemas.SALES_BY_CUSTOMER,
    schemas.SALES_BY_PRODUCT,
    LANDED_FILES,
)
KEY = "transaction_id"


@dataclass(frozen=True)
class Delta:
    """What a batch does to the marts: its judged rows, and earlier rows judged again."""

    staged: DataFrame
    again: DataFrame

    @property
    def added(self) -> DataFrame:
        """Valid rows of the batch."""
        return marts.valid_transactions(self.staged)

    @property
    def taken(self) -> DataFrame:
        """Rows that were valid until the batch repeated their id."""
        alone = self.again.where(F.size("dq_reasons") == 1).withColumn("is_valid", F.lit(True))
        return marts.valid_transactions(alone)


def land_batch(
    spark: SparkSession,
    source: str,
    root: str,
    batch: str,
    run_ts: datetime,
    options: Options = Options(),
) -> Snapshot | None:
    """Land the files below ``source`` that have not landed, and publish what follows.

    Without new files nothing is written; the snapshot is then the one before, if any.
    """
    with shuffles_removed(spark):
        base = Snapshots(spark, root).last()
        found = ledger.land_new(spark, source, base.read(LANDED_FILES), batch, run_ts)
        if found is None:
            return base if base.number else None
        raw, files = found
        return add_batch(Warehouse(spark, root, batch), base, raw, run_ts, files, options)


def add_batch(
    warehouse: Warehouse,
    base: Snapshot,
    raw: DataFrame,
    run_ts: datetime | str,
    files: DataFrame | None = None,
    options: Options = Options(),
) -> Snapshot:
    """Publish ``base`` with the rows ``raw`` added to it.

    ``files``: the batch's ledger rows, with which the landed rows must agree.
    """
    batch = warehouse.run_id
    if any(p.batch == batch for p in base.parts):
        raise ValueError(f"batch {batch} has been added already")
    with shuffles_removed(warehouse.spark):
        return _added(warehouse, base, raw, run_ts, files, options)


def _added(
    warehouse: Warehouse,
    base: Snapshot,
    raw: DataFrame,
    run_ts: datetime | str,
    files: DataFrame | None,
    options: Options,
) -> Snapshot:
    warehouse.store(schemas.RAW, raw, kept=base.parts_of(schemas.RAW))
    landed = warehouse.added(schemas.RAW)
    if files is not None:
        warehouse.store(LANDED_FILES, files, kept=base.parts_of(LANDED_FILES))
        ledger.reconcile(landed, warehouse.added(LANDED_FILES))

    index = grow_index(warehouse, base, landed, options.index_buckets)
    delta = judge(warehouse, base, landed, index)
    try:
        # One after the other: each shuffles rows of its table, and has tasks for all cores.
        months = change_fact(warehouse, base, delta)
        change_quarantine(warehouse, base, delta, run_ts)
        refresh(warehouse, base, delta, months)
        if not base.parts_of(schemas.DIM_DATE):
            warehouse.store(schemas.DIM_DATE, marts.dim_date(warehouse.spark, *options.spine))
        enforce(warehouse, delta, index)
    finally:  # nothing reads the judged rows any more: they are in the fact or in quarantine
        release(delta.staged, delta.again)
    return warehouse.publish(BATCHED, VIEWS, base)


def grow_index(
    warehouse: Warehouse, base: Snapshot, landed: DataFrame, buckets: int = key_counts.BUCKETS
) -> DataFrame:
    """The id counts after the batch, stored by bucket; only the batch's counts are shuffled."""
    added = key_counts.counts(landed.select(staging.typed_transaction_id()), KEY)
    warehouse.catalog.namespaces()
    before = stored_index(base, buckets)
    index = key_counts.grown(before, added, KEY, warehouse.run_id)
    path = warehouse.path(ID_INDEX.namespace, ID_INDEX.name)
    even = before is not None
    key_counts.write_bucketed(index, ID_INDEX, _index_table(path), path, even, buckets)
    warehouse.note(ID_INDEX)
    return warehouse.spark.table(_index_table(path))


def stored_index(snapshot: Snapshot, buckets: int = key_counts.BUCKETS) -> DataFrame | None:
    """The id counts of a snapshot, read by bucket; None before the first batch."""
    parts = snapshot.parts_of(ID_INDEX)
    if not parts:
        return None
    path = f"{snapshot.root}/{parts[0].path}"
    return key_counts.bucketed(snapshot.spark, ID_INDEX, _index_table(path), path, buckets)


def _index_table(path: str) -> str:
    return f"{ID_INDEX.full_name}__{crc32(path.encode()):08x}"


def judge(warehouse: Warehouse, base: Snapshot, landed: DataFrame, index: DataFrame) -> Delta:
    """The batch's rows, and the earlier rows whose id it repeats, with their verdicts.

    The index names the batch of those rows, so only raw rows of such batches are read.
    """
    repeated = materialise(key_counts.repeated(index).select(KEY, "n_rows"), "repeated-ids", CODEC)
    staged = _by_reader(staging.staged(landed, repeated, stored=True))
    staged = materialise(staged, "batch-staged", CODEC)
    ids = key_counts.newly_repeated(index).select(KEY, "first_batch")
    ids = materialise(ids, "newly-repeated", CODEC)
    batches = {r[0] for r in ids.select("first_batch").distinct().collect()}
    parts = [p for p in base.parts_of(schemas.RAW) if p.batch in batches]
    earlier = read_parts(warehouse.spark, base.root, schemas.RAW, parts)
    text_id = schemas.RAW.schema.names
    named = earlier.withColumn("_id", staging.typed_transaction_id())
    rows = places.among(named, ids.select(F.col(KEY).alias("_id")), "_id").select(*text_id)
    again = staging.staged(rows, ids.select(KEY, F.lit(2).cast("long").alias("n_rows")))
    delta = Delta(staged, materialise(again, "judged-again", CODEC))
    release(repeated, ids)
    return delta


def change_fact(warehouse: Warehouse, base: Snapshot, delta: Delta) -> list[str]:
    """Add the valid rows and take back the others; the months written anew.

    An id that is valid is held by no other row of any batch, and one that is taken back by
    one earlier row, so every key changes once.
    """
    added = marts.fct_transactions(delta.added)
    taken = marts.fct_transactions(delta.taken)
    changes = added.withColumns({"_deleted": F.lit(False), "_order": F.lit(1)}).unionByName(
        taken.withColumns({"_deleted": F.lit(True), "_order": F.lit(0)})
    )
    tests = checks.row_tests(checks.all_contract_checks(), schemas.FACT.name)
    return warehouse.upsert(schemas.FACT, changes, base, tests, keys_move=False, each_once=True)


def change_quarantine(
    warehouse: Warehouse, base: Snapshot, delta: Delta, run_ts: datetime | str
) -> None:
    """Add rejected rows; rows judged again are rejected with this run's time.

    Parts that hold a row rejected before and judged again are written anew.
    """
    relation = schemas.QUARANTINE
    text_id = F.col(f"{KEY}_raw").alias(KEY)
    before = base.read(relation)
    known = delta.again.where(F.size("dq_reasons") > 1).select(KEY)

    def with_id(rows: DataFrame) -> DataFrame:
        typed = staging.typed_transaction_id().alias("_id")
        return rows.select("*", text_id).select(*rows.columns, typed)

    parts = base.parts_of(relation)
    touched: set[str] = set()
    if parts:
        # A number for each folder: its name, as long as a row, would be shuffled with every id.
        # Two folders of one number are both written anew, which changes no row.
        folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
        number = F.xxhash64(folder).alias("_folder")
        held = base.files(relation).select(text_id, number)
        held = held.select(staging.typed_transaction_id(), "_folder").join(known, KEY, "left_semi")
        numbers = {r[0] for r in held.select("_folder").distinct().collect()}
        named = base.files(relation).select(folder, number).distinct().collect()
        folders = {name for name, n in named if n in numbers}
        touched = {p.path for p in parts if any(f.endswith("/" + p.path) for f in folders)}
    old = base.read(relation, [p for p in parts if p.path in touched])
    left = places.without(with_id(old), known.withColumnRenamed(KEY, "_id"), "_id")
    rows = left.select(*before.columns)
    for judged in (delta.staged, delta.again):
        rows = rows.unionByName(marts.quarantine(judged, run_ts))
    warehouse.store(relation, rows, kept=[p for p in parts if p.path not in touched])


def refresh(warehouse: Warehouse, base: Snapshot, delta: Delta, months: Sequence[str]) -> None:
    """Dimensions and summaries, from the rows and parts that changed."""
    _side_by_side(
        warehouse.spark,
        lambda: refresh_products(warehouse, base, delta),
        lambda: refresh_months(warehouse, base, months),
        lambda: refresh_customers(warehouse, base, delta),
        lambda: warehouse.store(
            schemas.COMPLETENESS,
            quality.completeness(
                warehouse.current(schemas.RAW),
                warehouse.current(schemas.FACT),
                warehouse.current(schemas.QUARANTINE),
            ),
        ),
    )


def refresh_products(warehouse: Warehouse, base: Snapshot, delta: Delta) -> None:
    """Counts per name and sums per product, added to and taken from."""
    added, taken = delta.added, delta.taken
    names = _added_up(
        [base.read(PRODUCT_NAMES), _named(added), _negative(_named(taken), "n_rows")],
        ["product_id", "product_name"],
    )
    names = warehouse.store(PRODUCT_NAMES, names.where("n_rows > 0"))
    products = warehouse.store(schemas.DIM_PRODUCT, names)

    sums = [c for c in PRODUCT_TOTALS.schema.names if c != "product_id"]
    totals = _added_up(
        [
            base.read(PRODUCT_TOTALS),
            aggregates.product_totals(added),
            _negative(aggregates.product_totals(taken), *sums),
        ],
        ["product_id"],
    )
    totals = _typed(totals.where("num_transactions > 0"), PRODUCT_TOTALS)
    totals = warehouse.store(PRODUCT_TOTALS, totals)
    warehouse.store(schemas.SALES_BY_PRODUCT, aggregates.product_sales(totals, products))


def refresh_months(warehouse: Warehouse, base: Snapshot, months: Sequence[str]) -> None:
    """The months written anew, from their files alone; other months keep their rows.

    The stored bitmaps of a month's ids give its distinct counts.
    """
    parts = [p for p in warehouse.parts[schemas.FACT.full_name] if p.part in months]
    written = read_parts(warehouse.spark, warehouse.root, schemas.FACT, parts)
    touched = F.col("month").cast("string").isin(list(months))
    kept = base.read(schemas.MONTHLY_IDS).where(~touched)
    ids = warehouse.store(
        schemas.MONTHLY_IDS, kept.unionByName(aggregates.monthly_ids(written))
    )
    sales = aggregates.monthly_sales_of(written, ids.where(touched))
    kept = base.read(schemas.MONTHLY_SALES).where(~touched)
    warehouse.store(schemas.MONTHLY_SALES, kept.unionByName(sales))


def refresh_customers(warehouse: Warehouse, base: Snapshot, delta: Delta) -> None:
    """The customers of added and taken rows, over all of their transactions."""
    fact = warehouse.current(schemas.FACT)
    if base.parts_of(schemas.SALES_BY_CUSTOMER):
        touched = delta.added.select("customer_id").union(delta.taken.select("customer_id"))
        touched = materialise(touched.distinct(), "touched-customers")
        kept = base.read(schemas.SALES_BY_CUSTOMER).join(touched, "customer_id", "left_anti")
        again = aggregates.sales_by_customer(fact.join(touched, "customer_id", "left_semi"))
        rows = kept.unionByName(again)
    else:  # the first batch brings every customer there is
        rows = aggregates.sales_by_customer(fact)
    sales = warehouse.store(schemas.SALES_BY_CUSTOMER, rows)
    warehouse.store(schemas.DIM_CUSTOMER, marts.dim_customer(sales))


def enforce(warehouse: Warehouse, delta: Delta, index: DataFrame) -> None:
    """Raise unless the contracts hold; nothing is published then.

    The counts of ids answer for the fact's key: a valid row's id is held by no other row.
    """
    shared = delta.added.join(key_counts.repeated(index), KEY, "left_semi").count()
    products = schemas.DIM_PRODUCT
    tested = checks.contract_checks(products)
    found = checks.results({products.name: warehouse.current(products)}, tested).collect()
    problems = [f"{r['check']}: {r['failures']}" for r in found if r["failures"]]
    problems += [f"{name}: {n}" for name, n in warehouse.counted.items() if n]
    if shared:
        problems.append(f"contract_{schemas.FACT.name}_primary_key: {shared}")
    if problems:
        raise ContractViolation("; ".join(problems))


def _side_by_side(spark: SparkSession, *jobs: Callable[[], object]) -> list:
    """Run independent jobs at the same time; their results."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        task = inheritable_thread_target(spark)(lambda job: job())
        return list(pool.map(task, jobs))


def _by_reader(staged: DataFrame) -> DataFrame:
    """Staged rows with the columns that their readers take: rejected rows go on as text,
    valid ones as typed values. The others are NULL, so each value is stored once."""
    valid, text_columns = F.col("is_valid"), [f"{c}_raw" for c in schemas.RAW_COLUMNS]
    always = {"dq_reasons", "is_valid", "_ingested_at"}
    return staged.select(
        *[
            F.col(c) if c in always else F.when(~valid if c in text_columns else valid, F.col(c)).alias(c)
            for c in staged.columns
        ]
    )


def _named(valid: DataFrame) -> DataFrame:
    return valid.groupBy("product_id", "product_name").agg(F.count("*").alias("n_rows"))


def _negative(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.withColumns({c: -F.col(c) for c in columns})


def _added_up(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """The other columns of all frames, summed per key."""
    both = frames[0]
    for frame in frames[1:]:
        both = both.unionByName(frame)
    return both.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in both.columns if c not in keys])


def _typed(rows: DataFrame, relation: schemas.Relation) -> DataFrame:
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in relation.schema])
