"""The batch load: read, parse, enrich, stage, audit, publish, then refresh the top-N tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace as dataclass_replace
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Observation, functions as F

from hitledger.operators import parsing
from hitledger.operators.enrich import with_derived
from hitledger.operators.summaries import counts_of_item
from hitledger.operators.topn import top_of_days
from hitledger.plans import dropped, upkeep
from hitledger.schemas import ACCESS_LOGS, REQUEST_COUNTS, TOP_TABLES, TopTableSpec
from hitledger.session import at_once, configure_session
from hitledger.sinks import layout, writers
from hitledger.sinks.audit import audit_top_tables, check
from hitledger.sinks.catalog import LogDatabase


@dataclass(frozen=True)
class LoadOptions:
    """How a load publishes.

    ``mode``: ``"append"`` adds rows, so loading the same files twice doubles them.
    ``"replace"`` replaces the days named in ``replace_days`` and no others, and can be
    repeated. Rows of other days in the input are left out and counted, so the input may and
    should include the neighbours of those days, where offsets put rows of theirs.

    ``empty_days``: what becomes of a day to replace for which the input has no row. ``"drop"``
    removes its rows and its rankings, as replacing it with nothing should; ``"refuse"`` fails
    the load before anything is published, and names such days.

    ``refresh``: ``"touched"`` recomputes the top-N partitions the loaded days belong to, from
    the counts kept for each day; ``"all"`` counts all rows again and recomputes every one.

    ``max_dropped_share``: the load fails if more than this share of the lines gives no row,
    for its format or for its time.

    ``keep_dropped``: lines without a row go to the table of dropped lines, in the place of what
    that has of the same files; the lines need ``file_path``.

    ``summaries``: also bring traffic and addresses per day up to date.
    """

    mode: str = "append"
    replace_days: tuple[date, ...] = ()
    empty_days: str = "drop"
    refresh: str = "touched"
    top_n: int = 5
    week_year: str = "calendar"
    max_dropped_share: float = 0.5
    keep_dropped: bool = False
    summaries: bool = False

    def __post_init__(self) -> None:
        if self.mode not in ("append", "replace"):
            raise ValueError(f"mode must be 'append' or 'replace', not {self.mode!r}")
        if self.refresh not in ("touched", "all"):
            raise ValueError(f"refresh must be 'touched' or 'all', not {self.refresh!r}")
        if self.empty_days not in ("drop", "refuse"):
            raise ValueError(f"empty_days must be 'drop' or 'refuse', not {self.empty_days!r}")
        if (self.mode == "replace") != bool(self.replace_days):
            raise ValueError("replace_days are what mode 'replace', and only it, needs")


@dataclass
class LoadReport:
    """Counts of one load. ``stored`` stays empty when there was nothing to load.

    lines_read = lines_rejected + bad_times + other_days + rows_enriched. ``days`` have rows of
    this load, ``emptied`` are days that were replaced and have none any more.
    """

    lines_read: int = 0
    lines_parsed: int = 0
    bad_times: int = 0
    other_days: int = 0
    rows_enriched: int = 0
    days: list[date] = field(default_factory=list)
    emptied: list[date] = field(default_factory=list)
    stored: dict[str, int] = field(default_factory=dict)

    @property
    def lines_rejected(self) -> int:
        return self.lines_read - self.lines_parsed


class RefreshError(Exception):
    """The rows of ``access_logs`` are published, but the top-N tables are not up to date.

    Loading again would append the rows again; ``refresh`` with the days of the report brings
    the tables up to date.
    """

    def __init__(self, report: LoadReport):
        days = report.days + report.emptied
        super().__init__(f"access_logs is published, refresh the top-N tables of {days}")
        self.report = report


def run(
    lines: DataFrame,
    database: LogDatabase,
    options: LoadOptions | None = None,
    published: Callable[[LoadReport], None] | None = None,
) -> LoadReport:
    """Load raw lines into ``access_logs`` and bring the tables made from it up to date.

    ``published`` is called as soon as the rows are there, also when there was none to load.
    """
    options = options or LoadOptions()
    configure_session(database.spark)
    database.create()
    report = _load_access_logs(lines, database, options)
    if published:
        published(report)
    changed = report.days + report.emptied
    if changed:
        try:
            report.stored.update(_refresh_top_tables(database, options, changed))
            if options.summaries:
                upkeep.summarize(database)
        except Exception as error:
            raise RefreshError(report) from error
    return report


def refresh(
    database: LogDatabase, options: LoadOptions | None = None, days: Iterable[date] = ()
) -> dict[str, int]:
    """Bring the top-N tables up to date with ``access_logs``; without days, all of them."""
    options = options or LoadOptions()
    configure_session(database.spark)
    database.create()
    days = sorted(days)
    if not days:
        options = dataclass_replace(options, refresh="all")
    stored = _refresh_top_tables(database, options, days)
    if options.summaries:
        upkeep.summarize(database, days or None)
    return stored


def store_dropped(lines: DataFrame, path: str) -> None:
    """Add the lines that a load gives no row for to parquet files, with the reason.

    Lines of ``scan_lines_by_file`` come with their file. This reads the lines on its own; a
    load with ``keep_dropped`` needs no second look at them, and can be repeated.
    """
    parsing.dropped_lines(lines).write.mode("append").parquet(path)


def replay_dropped(database: LogDatabase, options: LoadOptions | None = None) -> LoadReport:
    """Load the dropped lines again, after the rules that dropped them have changed.

    Lines that give a row now are added to ``access_logs`` and leave the table of dropped lines.
    """
    options = dataclass_replace(
        options or LoadOptions(), mode="append", replace_days=(), keep_dropped=True, max_dropped_share=1.0
    )
    configure_session(database.spark)
    return run(dropped.kept_lines(database), database, options)


def _staged_lines(
    lines: DataFrame, options: LoadOptions, observed: Observation
) -> tuple[DataFrame, Column]:
    """Rows to be staged, and the condition that tells rows of the table from dropped lines."""
    if options.keep_dropped and "file_path" not in lines.columns:
        raise ValueError("dropped lines are kept by file; the lines have no file_path")
    brought = ["value", *(["file_path"] if options.keep_dropped else [])]
    judged = with_derived(parsing.judged_lines(lines.select(*brought)))
    judged = judged.withColumn("processed_timestamp", F.current_timestamp())
    day, reason = F.col("date"), F.col("reason")
    good = reason.isNull()
    wanted = good & day.isin(list(options.replace_days)) if options.replace_days else good
    # All counts come from the one pass that writes the staging table. That pass has no
    # shuffle, so its tasks are result tasks, whose observed counts Spark adds once each
    # even when lost tasks run again.
    counted = judged.observe(
        observed,
        F.count(F.lit(1)).alias("lines_read"),
        F.count_if(good | (reason == "time")).alias("lines_parsed"),
        F.count_if(good).alias("rows_timed"),
        F.count_if(good & day.isNull()).alias("null_dates"),
        F.count_if(wanted).alias("rows_enriched"),
    )
    if not options.keep_dropped:
        return counted.where(wanted).select(*ACCESS_LOGS.columns), F.lit(True)
    line = F.when(~good, F.col("value")).alias("value")
    rows = counted.where(wanted | ~good).select(*ACCESS_LOGS.columns, line, "reason", "file_path")
    return rows, F.col("reason").isNull()


def _load_access_logs(
    lines: DataFrame, database: LogDatabase, options: LoadOptions
) -> LoadReport:
    observed = Observation()
    to_stage, good = _staged_lines(lines, options, observed)
    owned = set(options.replace_days)
    staged = database.new_staging_name(ACCESS_LOGS)
    try:
        writers.stage_rows(to_stage, database, staged)
        counts = dict(observed.get)
        report = LoadReport(
            counts["lines_read"],
            counts["lines_parsed"],
            counts["lines_parsed"] - counts["rows_timed"],
            counts["rows_timed"] - counts["rows_enriched"],
            counts["rows_enriched"],
        )
        all_staged = database.spark.table(database.qualified(staged))
        rows = all_staged.where(good).select(*ACCESS_LOGS.columns)
        counts["rows_staged"] = rows.count()  # from the footers, or from one column
        # One row per partition to be written, so no longer than the table's own listing.
        of_day = {row["date"]: row["count"] for row in rows.groupBy("date").count().collect() if row["date"]}
        report.days = sorted(of_day)
        without = sorted(owned - set(report.days))
        lost = report.lines_rejected + report.bad_times
        rules = {
            "date is NULL": counts["null_dates"] == 0,
            f"more than {options.max_dropped_share:.0%} of lines dropped": (
                lost <= options.max_dropped_share * report.lines_read
            ),
            "rows staged are not the rows counted": (
                counts["rows_staged"] == report.rows_enriched
            ),
            "a day outside those to replace": (
                options.mode == "append" or set(report.days) <= owned
            ),
            f"no rows for {', '.join(map(str, without))}, which are to be replaced": (
                options.empty_days == "drop" or not without
            ),
        }
        check(ACCESS_LOGS.name, rules, counts)
        there = upkeep.listed_days(database, ACCESS_LOGS) if without else set()
        report.emptied = sorted(there & set(without))
        upkeep.invalidate(database, report.days + report.emptied)
        each = layout.bytes_per_row(all_staged, all_staged.count()) if of_day else 0
        counted = [((day,), of_day[day]) for day in report.days]
        files = layout.files_for(counted, each, ACCESS_LOGS.target_file_bytes)
        if options.mode == "replace":
            mine = {ACCESS_LOGS: [(day,) for day in owned]}
            writers.replace_owned({ACCESS_LOGS: rows}, mine, database, {ACCESS_LOGS: files})
        elif report.days:
            writers.append(rows, database, ACCESS_LOGS, files)
        if report.days:
            report.stored[ACCESS_LOGS.name] = report.rows_enriched
        if options.keep_dropped:
            dropped.store(all_staged, database)
        return report
    finally:
        writers.drop_staged(database, staged)


def _refresh_top_tables(
    database: LogDatabase, options: LoadOptions, days: list[date]
) -> dict[str, int]:
    """Bring the counts per day and item up to date, and rank days and weeks from them.

    Rows are read for days without counts only; the other days of a week have theirs.
    """
    present = upkeep.listed_days(database, ACCESS_LOGS)
    touched = options.refresh == "touched"
    if touched:
        scope = present & set(days_of_weeks(days, options.week_year))
        stale = (scope - upkeep.counted_days(database)) | (set(days) & present)
    else:
        scope, stale = present, None
    upkeep.recount(database, stale)
    names = {spec: database.new_staging_name(spec) for spec in TOP_TABLES}
    counts = database.table(REQUEST_COUNTS)

    def rank(spec: TopTableSpec) -> None:
        counted = counts_of_item(counts, spec.item)
        if touched:
            counted = counted.where(F.col("date").isin(sorted(scope if spec.weekly else set(days))))
        top = top_of_days(counted, spec, options.top_n, options.week_year)
        stamped = top.withColumn("processed_timestamp", F.current_timestamp())
        writers.stage(stamped, database, spec, names[spec])

    try:
        at_once(database.spark, rank, TOP_TABLES)
        staged = {
            spec: database.spark.table(database.qualified(name)) for spec, name in names.items()
        }
        # days that were emptied have no rankings, and may be all there was
        stored = audit_top_tables(staged, options.top_n, not (present & set(days) if touched else present))
        owned = {}
        for spec in TOP_TABLES:
            if not touched:
                owned[spec] = [tuple(row) for row in database.partitions(spec).collect()]
            elif spec.weekly:
                owned[spec] = week_keys(days, options.week_year)
            else:
                owned[spec] = [(day,) for day in days]
        writers.replace_owned(staged, owned, database)
        return stored
    finally:
        for name in names.values():
            writers.drop_staged(database, name)


def week_keys(days: Iterable[date], week_year: str = "calendar") -> list[tuple[int, int]]:
    """Weekly partitions that the days belong to."""
    weeks = {(day, day.isocalendar()) for day in days}
    return sorted({(iso.year if week_year == "iso" else day.year, iso.week) for day, iso in weeks})


def days_of_weeks(days: Iterable[date], week_year: str = "calendar") -> list[date]:
    """All days that share a weekly partition with one of ``days``.

    With calendar years a partition is every day of one year with one ISO week number,
    which may be days of January and of December.
    """
    if week_year == "iso":
        mondays = {day - timedelta(days=day.weekday()) for day in days}
        return sorted(monday + timedelta(days=i) for monday in mondays for i in range(7))
    wanted = {(day.year, day.isocalendar().week) for day in days}
    result = []
    for year in {year for year, _ in wanted}:
        first = date(year, 1, 1)
        length = (date(year, 12, 31) - first).days + 1
        for day in (first + timedelta(days=i) for i in range(length)):
            if (year, day.isocalendar().week) in wanted:
                result.append(day)
    return sorted(result)
