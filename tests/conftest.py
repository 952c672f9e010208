from __future__ import annotations

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from siftledger.schemas import RAW_COLUMNS, SOURCE_SCHEMA
from siftledger.session import configured


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("siftledger-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
    )
    session = configured(builder).getOrCreate()
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


CLEAN = ("1", "10.0", "2024-01-05", "7", "Widget", "2.0", "10.50", "1.25")


@pytest.fixture(scope="session")
def feed(spark):
    """Raw rows from dicts of the columns that differ from a clean row."""

    def build(*changes: dict):
        rows = [
            tuple(({"transaction_id": str(i)} | change).get(c, d) for c, d in zip(RAW_COLUMNS, CLEAN))
            for i, change in enumerate(changes, start=1)
        ]
        return spark.createDataFrame(rows, SOURCE_SCHEMA).select(
            "*",
            F.lit("2024-01-02 03:04:05").cast("timestamp").alias("_ingested_at"),
            F.lit("rows").alias("_source_file"),
        )

    return build


@pytest.fixture(scope="session")
def edge_path():
    from pathlib import Path

    return str(Path(__file__).parent / "fixtures" / "edge.csv")
