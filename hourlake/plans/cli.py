"""Command line: publish landing hours as Parquet.

python -m hourlake.plans.cli --source s3a://bucket/landing/ \\
    --dest s3a://bucket/lake/events/ --date "2024-05-17 09"
"""

from __future__ import annotations

import argparse
import json
import sys

from hourlake.functions.hours import LAYOUTS
from hourlake.operators.parse import MODES
from hourlake.plans.ingest import ingest
from hourlake.plans.publish import STRATEGIES
from hourlake.session import build_session


def _schema(value: str | None) -> str | None:
    """A DDL string, or @path to a file holding one."""
    if value and value.startswith("@"):
        with open(value[1:], encoding="utf-8") as handle:
            return handle.read().strip()
    return value


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="hourlake", description=__doc__.splitlines()[0])
    p.add_argument("--source", required=True, help="landing root (any Hadoop URI)")
    p.add_argument("--dest", required=True, help="published table root")
    hours = p.add_mutually_exclusive_group()
    hours.add_argument("--date", help="one hour 'YYYY-MM-DD HH' or a day 'YYYY-MM-DD' (default: the current UTC hour)")
    hours.add_argument("--range", nargs=2, metavar=("START", "END"), help="inclusive range of hours or days")
    hours.add_argument("--changed", action="store_true", help="with --ledger: landed hours that are not as their latest successful run found them")
    hours.add_argument("--all", action="store_true", help="every landed hour")
    p.add_argument("--layout", choices=LAYOUTS, default="plain")
    p.add_argument("--schema", help="record schema as DDL, or @file; inferred when absent")
    p.add_argument("--mode", choices=MODES, default="PERMISSIVE")
    p.add_argument("--quarantine", help="table for bad documents")
    p.add_argument("--ledger", help="run ledger table")
    p.add_argument("--strategy", choices=STRATEGIES, default="direct")
    p.add_argument("--files-per-hour", type=int)
    p.add_argument("--target-file-bytes", type=int, help="landed bytes for each output file")
    p.add_argument("--swap", action="store_true", help="with --table: write beside the old hours, then point the table's partitions there")
    p.add_argument("--row-group-bytes", type=int)
    p.add_argument("--max-records-per-file", type=int)
    p.add_argument("--file-glob", help="only landing files matching this name pattern")
    p.add_argument("--table", help="register the published hours as this catalog table")
    p.add_argument("--clear-empty-hours", action="store_true",
                   help="with --table and a closed range: delete hours that have no landing file")
    p.add_argument("--clear-all", action="store_true", help="let --clear-empty-hours clear even if no file at all was found")
    p.add_argument("--clash-suffix", help="put behind the names of fields called like an hour key (year, month, day, hour)")
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    hours = "all" if args.all else "changed" if args.changed else tuple(args.range) if args.range else args.date
    spark = build_session(app_name="hourlake-ingest")
    report = ingest(spark, args.source, args.dest, hours, schema=_schema(args.schema),
                    layout=args.layout, mode=args.mode, quarantine=args.quarantine,
                    ledger=args.ledger, strategy=args.strategy,
                    files_per_hour=args.files_per_hour, row_group_bytes=args.row_group_bytes,
                    max_records_per_file=args.max_records_per_file, file_glob=args.file_glob,
                    table=args.table, clear_empty_hours=args.clear_empty_hours,
                    clear_all=args.clear_all, clash_suffix=args.clash_suffix,
                    target_file_bytes=args.target_file_bytes, swap=args.swap)
    print(json.dumps({"run_id": report.run_id, "status": report.status,
                      "documents": report.documents, "published": report.published,
                      "quarantined": report.quarantined}))
    return 0 if report.status == "succeeded" else 1


if __name__ == "__main__":
    sys.exit(main())
