"""Landing delimited files: dialect, headers, counts, reconciliation."""

from __future__ import annotations

from datetime import datetime, timezone

import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from siftledger.schemas import RAW, RAW_COLUMNS
from siftledger.sources import delimited
from siftledger.sources.delimited import ReconciliationError

HEADER = ",".join(RAW_COLUMNS)
ROW = "7,84.0,2022-03-09,55,Brass lamp,3.0,18.40,1.15"
RUN_TS = datetime(2024, 1, 2, tzinfo=timezone.utc)
SCAN_FAILURE = (PySparkException, Py4JJavaError)


@pytest.fixture
def source(tmp_path):
    def write(*lines, name="feed.csv", header=HEADER):
        (tmp_path / name).write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")
        return str(tmp_path / name)

    return write


def test_counts_records_without_header(spark, source):
    assert delimited.count_data_rows(spark, source(ROW)) == 1
    assert delimited.count_data_rows(spark, source(name="none.csv")) == 0


def test_header_only_source_is_valid(spark, source):
    delimited.validate_header(spark, source())


def test_header_names_are_trimmed(spark, source):
    path = source(ROW, header=HEADER.replace(",", " , "))
    delimited.validate_header(spark, path)
    assert delimited.count_data_rows(spark, path) == 1
    assert delimited.read_source(spark, path, RUN_TS).first().transaction_id == "7"


@pytest.mark.parametrize(
    "header", ["one,two", HEADER + ",note", ",".join(reversed(RAW_COLUMNS)), HEADER.upper()]
)
def test_other_headers_are_refused(spark, source, header):
    path = source("x,y", header=header)
    with pytest.raises(ValueError, match="header"):
        delimited.validate_header(spark, path)


def test_missing_and_empty_sources(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        delimited.validate_header(spark, str(tmp_path / "absent.csv"))
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(ValueError, match="empty"):
        delimited.validate_header(spark, str(tmp_path / "empty.csv"))


def test_every_file_of_a_folder_has_its_header_checked(spark, source, tmp_path):
    source(ROW, name="a.csv")
    source(ROW, ROW, name="b.csv")
    assert delimited.count_data_rows(spark, str(tmp_path)) == 3
    files = delimited.read_source(spark, str(tmp_path), RUN_TS)
    assert sorted(r._source_file for r in files.collect()) == ["a.csv", "b.csv", "b.csv"]
    source(ROW, name="c.csv", header=HEADER.replace(",", " , "))
    assert delimited.count_data_rows(spark, str(tmp_path)) == 4


@pytest.mark.parametrize("header", [HEADER.replace("price,tax", "tax,price"), HEADER.upper()])
def test_a_later_file_with_another_header_is_refused(spark, source, tmp_path, header):
    source(ROW, name="a.csv")
    source(ROW, name="b.csv", header=header)
    with pytest.raises(SCAN_FAILURE):
        delimited.count_data_rows(spark, str(tmp_path))
    assert spark.conf.get("spark.sql.caseSensitive") == "false"


def test_values_land_verbatim(spark, source):
    path = source(
        "T92,,23-11-2021,P6,  Oak shelf ,,on request,exempt",
        '2,"","2024-01-01",3,"Nut, ""hex""",1.0,007,\\N',
    )
    first, second = delimited.read_source(spark, path, RUN_TS).collect()
    assert tuple(first)[:8] == (
        "T92", None, "23-11-2021", "P6", "  Oak shelf ", None, "on request", "exempt",
    )
    assert tuple(second)[:8] == ("2", "", "2024-01-01", "3", 'Nut, "hex"', "1.0", "007", "\\N")


def test_schema_and_lineage(spark, source):
    rows = delimited.read_source(spark, source(ROW), RUN_TS)
    assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in RAW.schema]
    assert rows.first()._source_file == "feed.csv"
    assert rows.selectExpr("unix_timestamp(_ingested_at)").first()[0] == int(RUN_TS.timestamp())


@pytest.mark.parametrize("line", ["1,2,3", ROW + ",extra"])
def test_ragged_rows_stop_the_load_but_are_counted(spark, source, line):
    path = source(ROW, line)
    assert delimited.count_data_rows(spark, path) == 2
    with pytest.raises(SCAN_FAILURE):
        delimited.read_source(spark, path, RUN_TS).collect()


def test_line_breaks_in_quotes(spark, source):
    path = source('1,2.0,2024-01-01,3,"two\nlines",1.0,1.0,0.1')
    with pytest.raises(SCAN_FAILURE):
        delimited.read_source(spark, path, RUN_TS).collect()
    assert delimited.count_data_rows(spark, path, multi_line=True) == 1
    rows = delimited.read_source(spark, path, RUN_TS, multi_line=True).collect()
    assert [r.product_name for r in rows] == ["two\nlines"]


def test_blank_lines_are_no_records(spark, source):
    path = source(ROW, "", ROW)
    assert delimited.count_data_rows(spark, path) == 2
    assert delimited.read_source(spark, path, RUN_TS).count() == 2


def test_reconcile(spark, source):
    rows = delimited.read_source(spark, source(ROW), RUN_TS)
    assert delimited.reconcile(1, rows) == 1
    with pytest.raises(ReconciliationError, match="100 data rows, landed 1"):
        delimited.reconcile(100, rows)
