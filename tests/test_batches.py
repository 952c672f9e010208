"""Batches: files land once, ids are counted by bucket, and marts follow without a rebuild."""

from __future__ import annotations

import os
import random
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from siftledger import __main__ as command
from siftledger import schemas
from siftledger.operators import key_counts
from siftledger.plans import aggregates, batches, marts, quality, staging
from siftledger.plans.run import ContractViolation, Options
from siftledger.schemas import ID_INDEX, LANDED_FILES, RAW_COLUMNS
from siftledger.sinks.snapshots import Snapshots
from siftledger.sinks.warehouse import Warehouse
from siftledger.sources import ledger
from siftledger.sources.delimited import ReconciliationError

NOW = datetime(2024, 1, 2, 3, 4, 5, tzinfo=timezone.utc)
SMALL = Options(index_buckets=4)


def lines(rng, count):
    """Rows with ids that come again, in any later batch, and every kind of fault."""
    found = []
    for _ in range(count):
        i = rng.randint(1, 60)
        found.append(
            ",".join(
                [
                    rng.choice([str(i), f"T{i}", "x", ""]) if rng.random() < 0.3 else str(rng.randint(61, 400)),
                    rng.choice(["", "5.0", "6.0", f"{rng.randint(1, 9)}.0"]),
                    rng.choice(["n/a", f"2024-0{rng.randint(1, 5)}-1{rng.randint(0, 9)}"]),
                    str(rng.choice([7, 8, 9])),
                    "",
                    rng.choice(["1.0", "2.0", "0", ""]),
                    rng.choice(["2.00", "3.25", "words"]),
                    "0.10",
                ]
            )
        )
    # One name per product: the contract asks for it.
    rows = [line.split(",") for line in found]
    return [",".join([*r[:4], f"Name {r[3]}", *r[5:]]) for r in rows]


def write(folder, name, rows, header=",".join(RAW_COLUMNS)):
    path = Path(folder, name)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([header, *rows]) + "\n", encoding="utf-8")
    return path


def built_at_once(raw):
    staged = staging.staged(raw)
    valid = marts.valid_transactions(staged)
    fact, products = marts.fct_transactions(valid), marts.dim_product(valid)
    rejected = marts.quarantine(staged, NOW)
    return {
        schemas.FACT: fact,
        schemas.QUARANTINE: rejected,
        schemas.DIM_PRODUCT: products,
        schemas.DIM_CUSTOMER: marts.dim_customer(valid),
        schemas.MONTHLY_SALES: aggregates.monthly_sales(fact),
        schemas.SALES_BY_CUSTOMER: aggregates.sales_by_customer(fact),
        schemas.SALES_BY_PRODUCT: aggregates.sales_by_product(fact, products),
        schemas.COMPLETENESS: quality.completeness(raw, fact, rejected),
    }


def rows_of(df, relation):
    names = [n for n in relation.schema.names if n != "_quarantined_at"]
    return sorted(map(str, df.select(*names).collect()))


def test_batches_give_what_one_run_gives(spark, tmp_path):
    """Three batches of files in any order of ids; the second brings hardly anything new."""
    rng, root, source = random.Random(7), str(tmp_path / "w"), tmp_path / "in"
    seen = []
    for batch, count in (("b1", 90), ("b2", 3), ("b3", 120)):
        write(source, f"{batch}/part one+%.csv", lines(rng, count))
        write(source, f"{batch}/empty.csv", [])
        snapshot = batches.land_batch(spark, str(source), root, batch, NOW, SMALL)
        seen.append(snapshot.number)
    assert seen == [1, 2, 3]
    raw = snapshot.read(schemas.RAW)
    assert raw.count() == 213
    for relation, expected in built_at_once(raw).items():
        assert rows_of(snapshot.read(relation), relation) == rows_of(expected, relation), relation.name
    assert rows_of(spark.table("analytics.agg_monthly_sales"), schemas.MONTHLY_SALES) == rows_of(
        aggregates.monthly_sales(snapshot.read(schemas.FACT)), schemas.MONTHLY_SALES
    )
    counts = raw.select(staging.typed_transaction_id()).groupBy("transaction_id").count()
    stored = snapshot.read(ID_INDEX).select("transaction_id", "n_rows")
    assert sorted(map(tuple, stored.collect())) == sorted(
        map(tuple, counts.where("transaction_id IS NOT NULL").collect())
    )
    # Landing again adds nothing, and the ledger has every file with its rows.
    again = batches.land_batch(spark, str(source), root, "b4", NOW, SMALL)
    assert again.number == 3 and Snapshots(spark, root).latest() == 3
    files = {(r["batch"], r["name"]): r["n_rows"] for r in snapshot.read(LANDED_FILES).collect()}
    assert files == {(b, n): c if n == "part one+%.csv" else 0 for b, c in (("b1", 90), ("b2", 3), ("b3", 120))
                     for n in ("part one+%.csv", "empty.csv")}
    with pytest.raises(ValueError, match="already"):
        batches.add_batch(Warehouse(spark, root, "b1"), snapshot, raw, NOW)


def test_untouched_months_keep_their_files(spark, tmp_path):
    root, source = str(tmp_path / "w"), tmp_path / "in"
    write(source, "1.csv", [f"{i},5.0,2024-0{i}-11,7,Widget,1.0,2.00,0.10" for i in range(1, 6)])
    first = batches.land_batch(spark, str(source), root, "one", NOW, SMALL)
    write(source, "2.csv", ["9,6.0,2024-02-12,7,Widget,1.0,2.00,0.10", "4,6.0,2024-03-12,7,Widget,1.0,2.00,0.10"])
    second = batches.land_batch(spark, str(source), root, "two", NOW, SMALL)
    paths = [{p.part: p.path for p in s.parts_of(schemas.FACT)} for s in (first, second)]
    # 4 came again, so April loses its only row; March gains none, its new row is a repeat.
    assert set(paths[1]) == {f"2024-0{m}-01" for m in (1, 2, 3, 5)}
    assert {m for m in paths[1] if paths[0][m] != paths[1][m]} == {"2024-02-01"}
    monthly = {str(r["month"]): r["num_transactions"] for r in second.read(schemas.MONTHLY_SALES).collect()}
    assert monthly == {"2024-01-01": 1, "2024-02-01": 2, "2024-03-01": 1, "2024-05-01": 1}
    rejected = {r["transaction_id_raw"]: r["dq_reasons"] for r in second.read(schemas.QUARANTINE).collect()}
    assert rejected == {"4": ["duplicate_transaction_id"]} and second.read(schemas.QUARANTINE).count() == 2


def test_a_batch_neither_groups_whole_rows_nor_shuffles_the_ids_of_months(spark, tmp_path, monkeypatch):
    """Ids that come again, in a batch and over batches: every key changes once all the same."""
    root, source = str(tmp_path / "w"), tmp_path / "in"

    def refused(*_):
        raise AssertionError("not needed by a batch")

    monkeypatch.setattr("siftledger.sinks.warehouse.latest_changes", refused)
    monkeypatch.setattr(aggregates, "monthly_sales", refused)
    line = "{},{},2024-0{}-11,{},Widget,1.0,2.00,0.10".format
    first = [line(1, "5.0", 1, 7), line(2, "", 1, 8), line(3, "6.0", 2, 7), line(3, "6.0", 2, 7), "x,5.0,n/a,7,,,,"]
    write(source, "1.csv", first)
    batches.land_batch(spark, str(source), root, "one", NOW, SMALL)
    write(source, "2.csv", [line(2, "9.0", 3, 9), line(4, "5.0", 1, 7), line(3, "6.0", 2, 7), line("T5", "5.0", 3, 9)])
    second = batches.land_batch(spark, str(source), root, "two", NOW, SMALL)
    monkeypatch.undo()
    assert sorted(r["transaction_id"] for r in second.read(schemas.FACT).collect()) == [1, 4, 5]
    for relation, expected in built_at_once(second.read(schemas.RAW)).items():
        assert rows_of(second.read(relation), relation) == rows_of(expected, relation), relation.name


def test_a_broken_contract_publishes_nothing(spark, tmp_path):
    root, source = str(tmp_path / "w"), tmp_path / "in"
    write(source, "1.csv", ["1,5.0,2024-01-11,7,Widget,1.0,2.00,0.10"])
    batches.land_batch(spark, str(source), root, "one", NOW, SMALL)
    late = write(source, "2.csv", ["2,5.0,2024-01-11,7,Gadget,1.0,2.00,0.10"])
    with pytest.raises(ContractViolation, match="dim_product_primary_key"):
        batches.land_batch(spark, str(source), root, "two", NOW, SMALL)
    assert Snapshots(spark, root).latest() == 1
    assert spark.table("analytics.fct_transactions").count() == 1
    # The files of the failed batch have not landed: corrected, they do.
    write(source, "2.csv", ["2,5.0,2024-01-11,7,Widget,1.0,2.00,0.10"])
    assert late.exists()
    assert batches.land_batch(spark, str(source), root, "two", NOW, SMALL).number == 2
    assert spark.table("analytics.fct_transactions").count() == 2


def test_files_that_changed_or_differ_stop_a_batch(spark, tmp_path, monkeypatch):
    root, source = str(tmp_path / "w"), tmp_path / "in"
    path = write(source, "a/1.csv", ["1,5.0,2024-01-11,7,Widget,1.0,2.00,0.10"])
    batches.land_batch(spark, str(source), root, "one", NOW, SMALL)
    write(source, "b/1.csv", ["x,,,,,,,"])
    os.utime(path, (1_000_000_000, 1_000_000_000))
    with pytest.raises(ledger.ChangedFile, match="a/1.csv"):
        batches.land_batch(spark, str(source), root, "two", NOW, SMALL)
    landed = Snapshots(spark, root).open().read(LANDED_FILES)
    rows = Snapshots(spark, root).open().read(schemas.RAW)
    assert ledger.differences(rows, landed).count() == 0
    wrong = landed.withColumn("n_rows", F.col("n_rows") + 1)
    assert [tuple(r) for r in ledger.differences(rows, wrong).collect()] == [("1.csv", 2, 1)]
    with pytest.raises(ReconciliationError, match="1.csv: 2 counted, 1 landed"):
        ledger.reconcile(rows, wrong)
    write(source, "c/bad.csv", ["1,2"], header="a,b")
    os.utime(path, None)


def test_the_index_is_never_shuffled(spark, tmp_path):
    """The stored side of the join has no exchange, and is written back bucket by bucket."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS staging LOCATION '{tmp_path}/staging'")
    first = spark.range(500).selectExpr("id % 200 AS transaction_id")
    added = key_counts.counts(first, "transaction_id")
    key_counts.write_bucketed(
        key_counts.grown(None, added, "transaction_id", "a"), ID_INDEX, "staging.index_one", f"{tmp_path}/one", buckets=8
    )
    index = key_counts.bucketed(spark, ID_INDEX, "staging.index_one", f"{tmp_path}/one", 8)
    more = spark.range(190, 210).selectExpr("id AS transaction_id")
    more = more.union(spark.range(1).selectExpr("NULL"))
    grown = key_counts.grown(index, key_counts.counts(more, "transaction_id"), "transaction_id", "b")
    plan = grown._jdf.queryExecution().executedPlan().toString()
    stored = plan[plan.index("SortMergeJoin") : plan.index("Exchange")]
    assert "Bucketed: true" in stored and "SelectedBucketsCount: 8 out of 8" in stored
    assert "FileScan" not in plan[plan.index("Exchange") :]  # only the batch's counts are exchanged
    key_counts.write_bucketed(grown, ID_INDEX, "staging.index_two", f"{tmp_path}/two", even=True, buckets=8)
    assert len(list((tmp_path / "two").glob("*.parquet"))) == 8
    spark.sql("DROP TABLE staging.index_two")  # as a session without it finds it
    again = key_counts.bucketed(spark, ID_INDEX, "staging.index_two", f"{tmp_path}/two", 8)
    found = {r["transaction_id"]: tuple(r)[1:] for r in again.collect()}
    assert len(found) == 210
    assert found[5] == (3, 0, "a") and found[195] == (3, 1, "a") and found[205] == (1, 1, "b")
    assert sorted(r[0] for r in key_counts.repeated(again).select("transaction_id").collect()) == list(range(190, 200))
    # 100..199 were held twice by the first batch: none was held by one row alone.
    assert key_counts.newly_repeated(again).count() == 0


def test_command_line(spark, tmp_path, capsys):
    source, root = tmp_path / "in", str(tmp_path / "w")
    write(source, "1.csv", ["1,5.0,2024-01-11,7,Widget,1.0,2.00,0.10"])
    arguments = ["batch", str(source), root, "--spine-end", "2025-01-01"]
    command.main([*arguments, "--batch", "one"])
    assert "snapshot 1" in capsys.readouterr().out
    command.main([*arguments, "--batch", "two"])
    assert "snapshot 1" in capsys.readouterr().out
    command.main(["verify", root])
    assert "ok    analytics.fct_transactions/month=2024-01-01 1 1" in capsys.readouterr().out
    write(source, "2.csv", ["2,5.0,2024-01-12,7,Widget,1.0,2.00,0.10"])
    command.main([*arguments, "--batch", "two"])
    command.main(["expire", root, "--keep", "1"])
    assert "1 snapshots and" in capsys.readouterr().out
    command.main(["verify", root])
    with pytest.raises(FileNotFoundError):
        command.main(["verify", root, "--snapshot", "1"])


def test_a_batch_leaves_neither_judged_rows_nor_shuffles(spark, tmp_path, monkeypatch):
    """Also when nothing is published; what is stored is compressed closely."""
    from test_session import shuffle_files

    kept = tmp_path / "kept"
    monkeypatch.setattr("siftledger.session.scratch_dir", lambda _: str(kept))
    root, source = str(tmp_path / "w"), tmp_path / "in"
    names = ("repeated-ids", "batch-staged", "newly-repeated", "judged-again")

    def left():
        return [p.name for p in kept.glob("*/*") if p.name.startswith(names)]

    before = shuffle_files(spark)
    write(source, "1.csv", lines(random.Random(3), 40))
    batches.land_batch(spark, str(source), root, "one", NOW, SMALL)
    write(source, "2.csv", lines(random.Random(4), 40))
    snapshot = batches.land_batch(spark, str(source), root, "two", NOW, SMALL)
    assert left() == [] and shuffle_files(spark) <= before
    assert snapshot.read(schemas.RAW).count() == 80
    for relation in (schemas.RAW, schemas.FACT, schemas.QUARANTINE, ID_INDEX):
        files = snapshot.files(relation).inputFiles()
        assert files and all(".zstd." in f for f in files), relation.name
    write(source, "3.csv", ["901,5.0,2024-01-11,,Widget,1.0,2.00,0.10"])
    with pytest.raises(ContractViolation):
        batches.land_batch(spark, str(source), root, "three", NOW, SMALL)
    assert left() == []


def test_compressed_files_land_as_they_are(spark, feed, tmp_path):
    from stored_queries import write_csv

    named = ('say "so", ', "", "  x ")
    rows = feed(*[{"product_id": str(i), "product_name": n} for i, n in enumerate(named)], {"price": ""}, {"tax": None})
    rows = rows.where("product_name <> ''").union(feed({"transaction_id": "9", "product_name": "", "price": None}))
    write_csv(rows, str(tmp_path / "in" / "1"), "gzip")
    assert list((tmp_path / "in" / "1").glob("*.csv.gz"))
    snapshot = batches.land_batch(spark, str(tmp_path / "in"), str(tmp_path / "w"), "one", NOW, SMALL)
    landed = snapshot.read(schemas.RAW).select(*RAW_COLUMNS)
    assert sorted(map(str, landed.collect())) == sorted(map(str, rows.select(*RAW_COLUMNS).collect()))
    assert [r["n_rows"] > 0 for r in snapshot.read(LANDED_FILES).collect()].count(True) >= 1
