"""A dirty feed derived from order tables, for checks and benchmarks.

The order tables are clean, so each column is spoiled at fixed key residues. The
expressions run unchanged in Spark and in other SQL engines. No row is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed instants, so that repeated evaluations agree.
INGESTED_AT = "2024-01-02 03:04:05"
QUARANTINED_AT = "2024-01-02 04:00:00"
RUN_STARTED_AT = "2024-01-02 03:00:00"
INVOCATION_ID = "run-0001"
SOURCE_FILE = "lineitem.parquet"

# line: the unique-by-intent id of an order line; shipped: its ship date as text.
HELPERS = {
    "line": "l_orderkey * 10 + l_linenumber",
    "shipped": "cast(cast(l_shipdate as date) as string)",
}
USED = {
    "lineitem": (
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_quantity",
        "l_extendedprice",
        "l_tax",
        "l_shipdate",
    ),
    "orders": ("o_orderkey", "o_custkey"),
    "part": ("p_partkey", "p_name"),
}
COLUMNS = {
    "transaction_id": """case when line % 97 = 0 then 'X-' || cast(line as string)
        when l_orderkey % 10 = 0 then 'T' || cast(line as string) else cast(line as string) end""",
    "customer_id": """case when o_custkey % 7 = 0 then null
        else cast(o_custkey as string) || '.0' end""",
    "transaction_date": """case when l_orderkey % 101 = 0 then 'n/a'
        when l_orderkey % 211 = 0 then '2023-02-30'
        when l_orderkey % 8 = 0
            then substr(shipped, 9, 2) || '-' || substr(shipped, 6, 2) || '-' || substr(shipped, 1, 4)
        else shipped end""",
    "product_id": """case when l_partkey % 16 = 0 then 'P' || cast(l_partkey as string)
        else cast(l_partkey as string) end""",
    "product_name": "case when l_partkey % 9 = 0 then '  ' || p_name || ' ' else p_name end",
    "quantity": """case when line % 13 = 0 then null when line % 103 = 0 then '0'
        when line % 29 = 0 then '2.5'
        else cast(cast(l_quantity as decimal(12, 1)) as string) end""",
    "price": """case when line % 17 = 0 then 'on request' when line % 107 = 0 then '0'
        when line % 109 = 0 then '-7.25'
        when line % 113 = 0 then '123456789012345.25'
        when line % 127 = 0 then cast(cast(l_extendedprice as decimal(12, 2)) as string) || '6789'
        when line % 131 = 0 then cast(cast(l_extendedprice as decimal(12, 2)) as string) || '67891'
        when line % 137 = 0 then '1234567890123456789.5'
        when line % 139 = 0 then '0.0000004'
        else cast(cast(l_extendedprice as decimal(12, 2)) as string) end""",
    "tax": """case when line % 19 = 0 then 'exempt' when line % 149 = 0 then '0001234567890123456789'
        else cast(cast(cast(l_tax as decimal(12, 2)) * 100 as decimal(12, 2)) as string) end""",
}


# Every row is in one of three batches, by its ship date; ids come again in later ones.
BATCH = """case when l_shipdate < cast('1999-01-01' as timestamp) then 1
    when l_shipdate < cast('2001-01-01' as timestamp) then 2 else 3 end"""


def dirty_feed(spark: SparkSession, folder: str, batched: bool = False) -> DataFrame:
    """One raw row per order line of the tables in ``folder``, spoiled, with lineage.

    ``batched`` adds the number of the batch that brings the row.
    """
    lines, orders, parts = (
        spark.read.parquet(f"{folder}/{table}.parquet").select(*columns)
        for table, columns in USED.items()
    )
    joined = (
        _spread(lines)
        .join(_by_key(orders, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .join(_by_key(parts, "p_partkey"), F.col("l_partkey") == F.col("p_partkey"), "left")
    )
    return joined.withColumns({n: F.expr(e) for n, e in HELPERS.items()}).select(
        *[F.expr(e).alias(n) for n, e in COLUMNS.items()],
        F.lit(INGESTED_AT).cast("timestamp").alias("_ingested_at"),
        F.lit(SOURCE_FILE).alias("_source_file"),
        *([F.expr(BATCH).alias("batch")] if batched else []),
    )


def _by_key(table: DataFrame, key: str) -> DataFrame:
    """``table`` for a left join, grouped by its key where the key is found to be unique.

    Grouping tells Spark that the join keeps the number of rows, so that readers who ask for
    no column of the table do without the join and its shuffles. A key that repeats
    multiplies the lines it meets, as it always did.
    """
    keyed = table.where(F.col(key).isNotNull())
    repeats = keyed.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
    return keyed.dropDuplicates([key]) if repeats.isEmpty() else table


def _spread(scan: DataFrame) -> DataFrame:
    """Use all cores when a table is one row group; a larger scan is split already."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(cores, "l_partkey", "l_orderkey")
