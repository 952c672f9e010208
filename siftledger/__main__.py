"""Command line: run the warehouse, add a batch, verify or expire what is published, profile
what was landed, or test its age."""

from __future__ import annotations

import argparse
import logging
import uuid
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from siftledger.plans import checks, marts, profiling, quality
from siftledger.plans.checks import Severity
from siftledger.plans.batches import BATCHED, land_batch
from siftledger.plans.run import PUBLISHED, Options, attach, expire, run
from siftledger.plans.verify import verify
from siftledger.session import configured
from siftledger.sinks.snapshots import Snapshots
from siftledger.sinks.warehouse import Warehouse


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="siftledger", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    runs = commands.add_parser("run", help="land a source and build every relation")
    runs.add_argument("source", help="delimited file, or folder of files")
    runs.add_argument("root", help="warehouse folder")
    runs.add_argument("--run-id", default=None, help="repeat with the same id to retry a run")
    runs.add_argument("--spine-start", default=marts.SPINE_START)
    runs.add_argument("--spine-end", default=marts.SPINE_END, help="first day after the calendar")
    runs.add_argument(
        "--quarantine-alert-pct", type=float, default=quality.DEFAULT_QUARANTINE_ALERT_PCT
    )
    runs.add_argument(
        "--quarantine-fail-from", type=int, default=50, help="quarantined rows that fail the run"
    )
    runs.add_argument("--multi-line", action="store_true", help="quoted fields hold line breaks")
    runs.add_argument("--keep-going", action="store_true", help="failed tests do not fail the run")

    runs.add_argument(
        "--hold-failing", action="store_true", help="publish nothing if tests fail"
    )

    adds = commands.add_parser("batch", help="land the new files of a folder and add their rows")
    adds.add_argument("source", help="folder of delimited files")
    adds.add_argument("root", help="warehouse folder")
    adds.add_argument("--batch", default=None, help="name of the batch; letters, digits, . _ -")
    adds.add_argument("--spine-start", default=marts.SPINE_START)
    adds.add_argument("--spine-end", default=marts.SPINE_END)

    proofs = commands.add_parser("verify", help="test that published files are as committed")
    proofs.add_argument("root", help="warehouse folder")
    proofs.add_argument("--snapshot", type=int, default=None, help="number; the last by default")

    ends = commands.add_parser("expire", help="remove files that only old snapshots name")
    ends.add_argument("root", help="warehouse folder")
    ends.add_argument("--keep", type=int, required=True, help="snapshots that stay")

    asks = commands.add_parser("profile", help="answer the profiling questions on the landed rows")
    asks.add_argument("root", help="warehouse folder")
    asks.add_argument("--rows", type=int, default=20, help="rows of each stored answer to print")

    ages = commands.add_parser("freshness", help="test the age of the newest landed rows")
    ages.add_argument("root", help="warehouse folder")
    return top


def main(argv: list[str] | None = None) -> None:
    given = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    spark = configured(SparkSession.builder.appName("siftledger")).getOrCreate()
    actions = {
        "run": _run,
        "batch": _batch,
        "verify": _verify,
        "expire": _expire,
        "profile": _profile,
        "freshness": _freshness,
    }
    actions[given.command](spark, given)


def _run(spark: SparkSession, given: argparse.Namespace) -> None:
    result = run(
        spark,
        given.source,
        given.root,
        given.run_id or uuid.uuid4().hex,
        datetime.now(timezone.utc),
        Options(
            spine=(given.spine_start, given.spine_end),
            quarantine_alert_pct=given.quarantine_alert_pct,
            quarantine_severity=Severity(warn_above=0, fail_from=given.quarantine_fail_from),
            multi_line=given.multi_line,
            strict=not given.keep_going,
            publish_failing=not given.hold_failing,
        ),
    )
    result.summary.show(result.summary.count(), truncate=False)


def _batch(spark: SparkSession, given: argparse.Namespace) -> None:
    snapshot = land_batch(
        spark,
        given.source,
        given.root,
        given.batch or uuid.uuid4().hex,
        datetime.now(timezone.utc),
        Options(spine=(given.spine_start, given.spine_end)),
    )
    print("no new files" if snapshot is None else f"snapshot {snapshot.number}")


def _verify(spark: SparkSession, given: argparse.Namespace) -> None:
    snapshot = Snapshots(spark, given.root).open(given.snapshot)
    found = verify(snapshot, list({r.full_name: r for r in (*PUBLISHED, *BATCHED) if snapshot.parts_of(r)}.values()))
    rows = found.orderBy("ok", "item").collect()  # a line per table part and condition
    for row in rows:
        print("ok   " if row["ok"] else "WRONG", row["item"], row["expected"], row["found"])
    if not all(row["ok"] for row in rows):
        raise SystemExit(1)


def _expire(spark: SparkSession, given: argparse.Namespace) -> None:
    numbers, paths = expire(spark, given.root, given.keep)
    print(f"{len(numbers)} snapshots and {len(paths)} folders removed")


def _profile(spark: SparkSession, given: argparse.Namespace) -> None:
    published = attach(spark, given.root)
    store = Warehouse(spark, given.root, published.run_id)  # an attempt of its own
    for question, answer in profiling.profile(spark.table("raw.customer_transactions")).items():
        stored = store.write(answer, "dq_audit", f"profile_{question}")
        order = list(answer.columns)
        print(f"=== {question}: {stored.count()} rows in {store.path('dq_audit', f'profile_{question}')}")
        stored.orderBy(*order).show(given.rows, truncate=False)


def _freshness(spark: SparkSession, given: argparse.Namespace) -> None:
    attach(spark, given.root)
    raw = spark.table("raw.customer_transactions")
    result = checks.freshness(raw, datetime.now(timezone.utc))
    result.show(truncate=False)
    if result.first()["status"] == "fail":
        raise SystemExit(1)


if __name__ == "__main__":
    main()
