"""Command line, for ``spark-submit`` or ``python -m headway``.

    ingest  landed schedule documents into the raw table, once or continuously, with what was rejected
    compact fold the micro-batches of closed days into few clustered files
    marts   rebuild the mart tables from the raw table
    check   run the data-quality checks; exit status 1 if any row fails, 2 if a check could not be run
    report  one page of statistics, printed whole or written to a folder
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from headway import get_session
from headway.operators.quality import run_checks
from headway.plans.marts import build_marts, read_marts
from headway.plans.models import STAGING_COLUMNS, stg_arrivals
from headway.plans.report import DAYS_BACK, HOURS_BACK, build_report
from headway.schemas import EXTENDED_RAW, RAW
from headway.session import GIB, fit_session
from headway.sources.batches import compact, is_batch_table, read_accepted
from headway.sources.raw import read_raw, read_raw_table
from headway.sources.schedules import read_schedule_stream
from headway.streaming.ingest import ONCE, POLL_INTERVAL, follow_outcomes, start_outcomes


#: Copies of one time are told apart by all their values, so that every command keeps the same one.
TIE_BREAK = [c for c in STAGING_COLUMNS if c not in ("arrival_id", "ingestion_timestamp")]


def _raw_arguments(command: argparse.ArgumentParser) -> None:
    source = command.add_mutually_exclusive_group(required=True)
    source.add_argument("--raw", nargs="+", help="folders of the raw table")
    source.add_argument("--table", nargs="+", help="raw tables of the catalog")


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="headway", description=__doc__.splitlines()[0])
    parser.add_argument("--input-gib", type=int, help="rough size of the input, to size shuffles by; default that of the raw table")
    commands = parser.add_subparsers(dest="command", required=True)

    ingest = commands.add_parser("ingest")
    ingest.add_argument("--landing", required=True, help="folder of landed documents")
    ingest.add_argument("--raw", required=True, help="folder of the raw table")
    ingest.add_argument("--checkpoint", required=True, help="folder of the stream's state")
    ingest.add_argument("--archive", help="folder outside the landing one, for documents that were read")
    ingest.add_argument("--continuous", action="store_true", help="go on polling instead of draining once")
    ingest.add_argument("--interval", default=POLL_INTERVAL)
    ingest.add_argument("--lines", help="comma-separated line codes; default all")
    ingest.add_argument("--max-files", type=int, help="documents files per micro-batch")
    ingest.add_argument("--max-bytes", type=int, help="bytes of documents per micro-batch")

    folds = commands.add_parser("compact")
    folds.add_argument("--raw", required=True, help="folder of the raw table that ingest writes")
    folds.add_argument("--before", type=dt.date.fromisoformat, help="first day that is still open; default none is")

    marts = commands.add_parser("marts")
    _raw_arguments(marts)
    marts.add_argument("--out", help="folder for the marts; default tables of the catalog")
    marts.add_argument("--database", help="database of those tables; default the current one")

    check = commands.add_parser("check")
    _raw_arguments(check)
    check.add_argument("--marts", help="folder that the marts command wrote; default tables of the catalog")
    check.add_argument("--database", help="database of those tables; default the current one")

    report = commands.add_parser("report")
    _raw_arguments(report)
    report.add_argument("--marts", help="folder that the marts command wrote, for the tiles")
    report.add_argument("--database", help="database of the marts, for the tiles")
    report.add_argument("--delays", action="store_true", help="the raw table has the columns on delays; tiles for them")
    report.add_argument("--date")
    report.add_argument("--lines", help="comma-separated line names")
    report.add_argument("--hours", help="first-last, such as 7-10")
    report.add_argument("--station")
    report.add_argument("--hours-back", type=int, default=HOURS_BACK, help="rows of the last hours; 0 for all")
    report.add_argument("--days-back", type=int, default=DAYS_BACK, help="anomalies of the last days; 9999 for all")
    report.add_argument("--as-of", type=dt.datetime.fromisoformat, help="the time to count back from, UTC; default now")
    report.add_argument("--limit", type=int, help="newest rows only; default all")
    report.add_argument("--out", help="folder for one parquet table a statistic, instead of printing")
    return parser.parse_args(argv)


def _read_folders(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """Raw tables in folders, whether ``ingest`` or ``append_raw`` wrote them."""
    parts = [
        read_accepted(spark, path) if schema is RAW and is_batch_table(spark, path) else read_raw(spark, path, schema=schema)
        for path in paths
    ]
    return reduce(DataFrame.unionByName, parts)


def _split(text: str | None) -> list[str]:
    return text.split(",") if text else []


def main(argv: list[str] | None = None) -> int:
    args = _arguments(argv)
    input_bytes = args.input_gib * GIB if args.input_gib else None
    spark = get_session(f"headway-{args.command}", input_bytes=input_bytes)
    if args.command == "ingest":
        stream = read_schedule_stream(spark, args.landing, args.max_files, args.max_bytes, args.archive)
        trigger = args.interval if args.continuous else ONCE
        query = start_outcomes(stream, args.raw, args.checkpoint, trigger, lines=_split(args.lines) or None)
        summary = follow_outcomes(spark, query, args.raw)
        print(json.dumps(summary))
        return 0 if summary["status"] == "success" else 1
    if args.command == "compact":
        print(json.dumps(compact(spark, args.raw, args.before)))
        return 0
    schema = EXTENDED_RAW if args.command == "report" and args.delays else RAW
    raw = _read_folders(spark, args.raw, schema) if args.raw else read_raw_table(spark, *args.table, schema=schema)
    if input_bytes is None:
        fit_session(raw)
    if args.command == "marts":
        for name, df in build_marts(spark, raw, args.out, tie_break=TIE_BREAK, database=args.database).items():
            print(name, df.count())
        return 0
    if args.command == "check":
        models = read_marts(spark, args.marts, args.database)
        results = run_checks({"stg_arrivals": stg_arrivals(raw, tie_break=TIE_BREAK), **models}).collect()
        for row in results:
            print(f"{row.model}.{row['column']} {row.test}: {'not run' if row.failures is None else row.failures}")
        if any(row.failures for row in results):
            return 1
        return 2 if any(row.failures is None for row in results) else 0
    hours = tuple(map(int, args.hours.split("-"))) if args.hours else None
    fact = read_marts(spark, args.marts, args.database)["fact_delays"] if args.marts or args.database else None
    page = build_report(
        raw, args.date, _split(args.lines), hours, args.station, args.as_of, args.limit, args.hours_back,
        args.days_back, fact,
    )
    if page.note:
        print(page.note)
    for name, df in page.frames.items():
        if args.out:
            df.write.mode("overwrite").parquet(f"{args.out}/{name}")
            continue
        print(name, *df.columns, sep="\t")
        for row in df.toLocalIterator():
            print(*row, sep="\t")
    page.close()
    return 0


if __name__ == "__main__":
    sys.exit(main())
