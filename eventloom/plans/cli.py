"""Command line: stages, export, recovery, launch, acquisition, validation."""

from __future__ import annotations

import argparse
import json
import os
import sys
from collections.abc import Sequence
from pathlib import Path

from ..sources import acquire
from ..streaming.batches import bounds, day_of, run_days
from . import export, rivals, verify
from .jobs import STAGES, Jobs
from .policy import TARGET_BYTES, ShufflePolicy, session, submit_command
from .store import Store


def positive(text: str) -> int:
    value = int(text)
    if value < 1:
        raise argparse.ArgumentTypeError("must be positive")
    return value


def folder(text: str) -> str:
    if not text.strip():
        raise argparse.ArgumentTypeError("must not be empty")
    return text


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="eventloom")
    commands = top.add_subparsers(dest="command", required=True)
    for stage in (*STAGES, "pipeline"):
        p = commands.add_parser(stage)
        for option in ("--date", "--start-date", "--end-date", "--resume-date"):
            p.add_argument(option, type=day_of)
        p.add_argument("--from-stage", choices=STAGES, default=STAGES[0])
        p.add_argument("--shuffle-partitions", type=positive)
        p.add_argument("--shuffle-target-bytes", type=positive, default=TARGET_BYTES)
        p.add_argument("--raw-root", type=folder, default="data/raw")
        p.add_argument("--output-root", type=folder, default="data/parquet")
        p.add_argument("--top-n", type=positive, default=10)
    p = commands.add_parser("export")
    p.add_argument("--date", type=day_of, required=True)
    p.add_argument("--parquet-root", default="data/parquet")
    p.add_argument("--mode", choices=("csv", "duckdb", "both"), default="both")
    p.add_argument("--csv-root", default="data/csv")
    p.add_argument("--database", default="data/metrics.duckdb")
    p = commands.add_parser("verify-export")
    p.add_argument("--date", type=day_of, required=True)
    p.add_argument("--parquet-root", default="data/parquet")
    p.add_argument("--csv-root", default="data/csv")
    p.add_argument("--database", default="data/metrics.duckdb")
    p.add_argument("--report")
    p = commands.add_parser("recover")
    p.add_argument("--dataset-root", required=True)
    p.add_argument("--date", type=day_of, required=True)
    p.add_argument("--action", choices=("inspect", "rollback", "commit"), default="inspect")
    p = commands.add_parser("acquire")
    p.add_argument("--date", type=day_of, required=True)
    p.add_argument("--hours", type=int, nargs="+", default=[0])
    p.add_argument("--base-url", required=True)
    p.add_argument("--raw-root", default="data/raw")
    p.add_argument("--manifest", required=True)
    p.add_argument("--plan", help="a manifest whose sources are fetched without asking for sizes again")
    p.add_argument("--head-only", action="store_true")
    p.add_argument("--max-file-bytes", type=positive, default=acquire.MAX_FILE)
    p.add_argument("--max-total-bytes", type=positive, default=acquire.MAX_TOTAL)
    p = commands.add_parser("expect")
    p.add_argument("--date", type=day_of, required=True)
    p.add_argument("--raw-root", required=True)
    p.add_argument("--destination", required=True)
    p = commands.add_parser("validate")
    p.add_argument("--date", type=day_of, required=True)
    p.add_argument("--output-root", required=True)
    p.add_argument("--oracle")
    p.add_argument("--compare-root")
    p.add_argument("--manifest")
    p.add_argument("--report")
    p = commands.add_parser("compare-plain")
    p.add_argument("--date", type=day_of, required=True)
    p.add_argument("--plain-root", required=True)
    p.add_argument("--output-root", required=True)
    p = commands.add_parser("rivals")
    p.add_argument("--rows", type=positive, default=150_000)
    p.add_argument("--width", type=positive, default=32)
    p.add_argument("--runs", type=positive, default=3)
    p = commands.add_parser("launch", add_help=False)
    p.add_argument("rest", nargs=argparse.REMAINDER)
    return top


def report(value: dict, path: str | None = None) -> None:
    text = json.dumps(value, indent=2, sort_keys=True, default=str)
    if path:
        Path(path).write_text(text + "\n", encoding="utf-8")
    print(text)


def run_stage(top: argparse.ArgumentParser, given: argparse.Namespace) -> None:
    """Everything is checked before a session exists."""
    try:
        first, last = bounds(given.date, given.start_date, given.end_date, given.resume_date)
    except ValueError as error:
        top.error(str(error))
    if given.command != "pipeline" and given.from_stage != STAGES[0]:
        top.error("--from-stage belongs to the pipeline")
    if Path(given.raw_root).resolve() == Path(given.output_root).resolve():
        top.error("input and output must be different folders")
    spark = session(f"eventloom-{given.command}")
    try:
        policy = ShufflePolicy(spark, given.shuffle_partitions, given.shuffle_target_bytes)
        jobs = Jobs(spark, given.raw_root, given.output_root, given.top_n, policy)
        run_days(lambda stage, day, start: print(f"{day} {stage}: {jobs.run(stage, day, start)}", flush=True), given.command, first, last, given.from_stage)
    finally:
        spark.stop()


def run_acquire(given: argparse.Namespace) -> None:
    day, hours = str(given.date), acquire.hours_of(given.hours)
    if given.plan:
        archives = [acquire.Archive(**s) for s in json.loads(Path(given.plan).read_text())["sources"]]
    else:
        archives = acquire.plan(day, hours, given.base_url)
    acquire.check_plan(archives, day, hours, given.base_url, given.max_file_bytes, given.max_total_bytes)
    if given.head_only:
        report({"date": day, "sources": [vars(a) for a in archives], "completed": [], "complete": False}, given.manifest)
    else:
        report(acquire.acquire(day, archives, given.raw_root, given.manifest, max_file=given.max_file_bytes))


def main(argv: Sequence[str] | None = None) -> int:
    argv = list(sys.argv[1:] if argv is None else argv)
    if argv[:1] == ["launch"]:
        command = submit_command(argv[1:])
        os.execvp(command[0], command)
    top = parser()
    given = top.parse_args(argv)
    if given.command in (*STAGES, "pipeline"):
        run_stage(top, given)
    elif given.command == "export":
        csv_root = given.csv_root if given.mode != "duckdb" else None
        database = given.database if given.mode != "csv" else None
        report(export.export_day(given.parquet_root, given.date, csv_root, database))
    elif given.command == "verify-export":
        report(export.verify_export(given.parquet_root, given.csv_root, given.database, given.date), given.report)
    elif given.command == "recover":
        store = Store(given.dataset_root)
        report(store.inspect(given.date) if given.action == "inspect" else {"outcome": store.recover(given.date, given.action)})
    elif given.command == "acquire":
        run_acquire(given)
    elif given.command == "expect":
        report(verify.write_expected(given.raw_root, given.date, given.destination))
    elif given.command == "compare-plain":
        found = verify.compare_plain(session("eventloom-compare"), given.plain_root, given.output_root, given.date)
        report(found)
        return int(not all(found.values()))
    elif given.command == "rivals":
        report(rivals.measure(session("eventloom-rivals"), given.rows, given.width, given.runs))
    elif given.command == "validate":
        if not (given.oracle or given.compare_root) or (given.manifest and not given.oracle):
            top.error("validate needs --oracle or --compare-root, and --manifest needs --oracle")
        manifest = json.loads(Path(given.manifest).read_text()) if given.manifest else None
        found = verify.validate_day(session("eventloom-validate"), given.output_root, given.date, given.oracle, given.compare_root, manifest)
        report(found, given.report)
        return int(not found["passed"])
    return 0


if __name__ == "__main__":
    sys.exit(main())
