"""Command line of the batch load."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from hitledger.operators import reports
from hitledger.plans.batch import LoadOptions, LoadReport, refresh, replay_dropped, run
from hitledger.plans.newfiles import append_new_files, replace_days
from hitledger.schemas import ACCESS_LOGS, ALL_TABLES, DAILY_TOP_DEVICES, DAILY_TOP_IPS, DROPPED_LINES
from hitledger.session import configure_session
from hitledger.sinks.catalog import DEFAULT_DATABASE, LogDatabase
from hitledger.sinks.compaction import compact
from hitledger.sources import text_logs


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="hitledger", description="Load access logs.")
    parser.add_argument("--input-path", required=True, help="glob of the gzipped log files")
    parser.add_argument("--warehouse", required=True, help="shared location of the tables")
    parser.add_argument("--app-name", default="hitledger")
    parser.add_argument("--database", default=DEFAULT_DATABASE)
    parser.add_argument("--process-date", help="load only this day's directory (YYYY-MM-DD)")
    parser.add_argument("--hive-layout", action="store_true", help="days are year=/month=/day=")
    parser.add_argument(
        "--spread-lines", action="store_true", help="deal lines out evenly: few, large files"
    )
    parser.add_argument(
        "--spread-above", type=int, metavar="BYTES", help="deal out the lines of larger files only"
    )
    parser.add_argument(
        "--new-files", action="store_true", help="append only files that were not loaded before"
    )
    parser.add_argument("--mode", choices=("append", "replace"), default="append")
    parser.add_argument("--refresh", choices=("touched", "all"), default="touched")
    parser.add_argument(
        "--refresh-only", action="store_true", help="load nothing, recompute the top-N tables"
    )
    parser.add_argument(
        "--empty-days", choices=("drop", "refuse"), default="drop",
        help="what becomes of a day to replace that has no row in the input",
    )
    parser.add_argument(
        "--keep-dropped", action="store_true", help="keep lines without a row, and why, in a table"
    )
    parser.add_argument("--dropped-path", help="keep them in a table at this shared location")
    parser.add_argument(
        "--replay-dropped", action="store_true", help="only load the kept lines without a row again"
    )
    parser.add_argument("--summaries", action="store_true", help="also keep traffic and addresses per day")
    parser.add_argument(
        "--compact", action="store_true", help="afterwards put small files of access_logs together"
    )
    parser.add_argument("--week-year", choices=("calendar", "iso"), default="calendar")
    parser.add_argument("--top-n", type=int, default=5)
    parser.add_argument(
        "--max-dropped-share", type=float, default=0.5, help="fail beyond this share of lines"
    )
    return parser


def print_summary(database: LogDatabase, report: LoadReport) -> None:
    print(f"lines read {report.lines_read:,}, parsed {report.lines_parsed:,}")
    print(f"without a valid time {report.bad_times:,}, of other days {report.other_days:,}")
    print(f"rows enriched {report.rows_enriched:,}")
    if report.emptied:
        print(f"days without rows now: {', '.join(map(str, report.emptied))}")
    for path in getattr(report, "changed_files", []):
        print(f"changed since it was loaded, replace its day: {path}")
    if report.stored or report.emptied:
        print_tables(database)
    else:
        print("nothing to load")


def print_tables(database: LogDatabase) -> None:
    logs, days = database.table(ACCESS_LOGS), database.days(ACCESS_LOGS)
    reports.table_row_counts(database.tables()).show(len(ALL_TABLES), truncate=False)
    reports.data_range_summary(logs, days).show(truncate=False)
    reports.recent_daily_summary(logs, days).show(truncate=False)
    for spec in (DAILY_TOP_IPS, DAILY_TOP_DEVICES):
        top = reports.latest_top(database.table(spec), spec.item, database.days(spec))
        top.show(top.count(), truncate=False)


def main(argv: list[str] | None = None) -> int:
    parser = arguments()
    args = parser.parse_args(argv)
    day = None
    replaces = args.mode == "replace" and not args.refresh_only
    if replaces and not args.process_date:
        parser.error("--mode replace needs --process-date")
    if args.process_date:
        try:
            day = text_logs.parse_day(args.process_date)
            text_logs.day_path(args.input_path, day, args.hive_layout)
        except ValueError as error:
            print(f"Error: {error}", file=sys.stderr)
            return 1
    if args.new_files and args.mode == "replace":
        parser.error("--new-files appends, --mode replace takes whole days")
    options = LoadOptions(
        mode="replace" if replaces else "append",
        replace_days=(day,) if replaces else (),
        empty_days=args.empty_days,
        refresh=args.refresh,
        top_n=args.top_n,
        week_year=args.week_year,
        max_dropped_share=args.max_dropped_share,
        keep_dropped=args.keep_dropped or bool(args.dropped_path),
        summaries=args.summaries,
    )
    spark = configure_session(SparkSession.builder.appName(args.app_name).getOrCreate())
    try:
        places = {DROPPED_LINES.name: args.dropped_path} if args.dropped_path else {}
        database = LogDatabase(spark, args.warehouse, args.database, places)
        if args.refresh_only:
            refresh(database, options, [day] if day else [])
            print_tables(database)
            return 0
        path, how = args.input_path, {"spread": args.spread_lines, "spread_above": args.spread_above}
        if args.replay_dropped:
            report = replay_dropped(database, options)
        elif replaces:
            report = replace_days(database, path, [day], options, args.hive_layout, **how)
        else:
            path = text_logs.day_path(path, day, args.hive_layout) if day else path
            if args.new_files:
                report = append_new_files(database, path, options, args.spread_above)
            else:
                lines = text_logs.scan_lines(spark, path, by_file=options.keep_dropped, **how)
                report = run(lines, database, options)
        if args.compact:
            done = compact(database, ACCESS_LOGS)
            print(f"files put together: {done.files_before} to {done.files_after}")
        print_summary(database, report)
    finally:
        spark.stop()
    return 0
