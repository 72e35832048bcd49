"""Entry points: the flagship query, every query by name, and the SQL each must agree with.

Queries on raw lines derive them from ``events``. Queries the stored tables answer run on
tables loaded once per session and data set, through the whole batch load, below the
shared scratch folder.
"""

from __future__ import annotations

import datetime as dt
import os
import sys
import uuid
from collections.abc import Callable
from functools import reduce, wraps
from pathlib import Path
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession, functions as F

ROOT = str(Path(__file__).resolve().parent)
sys.path.insert(0, ROOT)

from hitledger.functions import derived  # noqa: E402
from hitledger.operators import parsing, reports, summaries, topn  # noqa: E402
from hitledger.operators.enrich import access_logs  # noqa: E402
from hitledger.plans import batch, newfiles, upkeep  # noqa: E402
from hitledger.plans.batch import LoadOptions  # noqa: E402
from hitledger.schemas import (  # noqa: E402
    ACCESS_LOGS,
    DAILY_ADDRESSES,
    DAILY_TOP_DEVICES,
    DAILY_TOP_IPS,
    DAILY_TRAFFIC,
    DROPPED_LINES,
    REQUEST_COUNTS,
    TOP_TABLES,
    WEEKLY_TOP_DEVICES,
    WEEKLY_TOP_IPS,
    TableSpec,
    TopTableSpec,
)
from hitledger.session import configure_session, scratch_dir  # noqa: E402
from hitledger.sinks import compaction, writers  # noqa: E402
from hitledger.sinks.catalog import LogDatabase  # noqa: E402
from hitledger.sources import text_logs  # noqa: E402
from oracle import access_log_sql  # noqa: E402
from oracle.event_lines import event_lines  # noqa: E402

try:  # the text operators and their pipeline are optional
    import corpus_pipeline  # noqa: E402
    from hitledger.llm import registry as llm  # noqa: E402
except ModuleNotFoundError as error:
    # only they themselves may be missing; a package that they need, or a typing error, is a fault
    if error.name not in ("corpus_pipeline", "hitledger.llm"):
        raise
    corpus_pipeline = llm = None

Query = Callable[[SparkSession, str], DataFrame]

DAY = "2025-01-05"
SINCE = "2025-01-01"
LAST = "2025-01-31"
FIRST_HOUR, LAST_HOUR = 10, 12
#: Days that are replaced by nothing: DAY, and every day of the week after it.
EMPTIED = [str(dt.date.fromisoformat(DAY) + dt.timedelta(days=i)) for i in range(8)]


#: Files of the archive above this size are dealt out; some are and some are not.
SPREAD_ABOVE = 1_500

Made = TypeVar("Made")


def _once(make: Callable[[SparkSession, str], Made]) -> Callable[[SparkSession, str], Made]:
    """Make something once per application and data set."""
    made: dict[tuple[str, str], Made] = {}

    @wraps(make)
    def get(spark: SparkSession, sf_dir: str) -> Made:
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in made:
            made[key] = make(spark, sf_dir)
        return made[key]

    return get


@_once
def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure_session(spark)
    return event_lines(spark.read.parquet(f"{sf_dir}/events.parquet"))


@_once
def _logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched rows; the load time is left out because it differs from run to run."""
    return _comparable(access_logs(_lines(spark, sf_dir)))


def _comparable(df: DataFrame) -> DataFrame:
    """Rows without load time and with instants as UTC wall-clock time."""
    df = df.drop("processed_timestamp")
    if "timestamp" in df.columns:
        df = df.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    return df


@_once
def _archive(spark: SparkSession, sf_dir: str) -> str:
    """Glob of a gzip text archive of the lines."""
    root = f"{scratch_dir(spark)}/hitledger-{uuid.uuid4().hex}/archive"
    text_logs.export_lines(_lines(spark, sf_dir), "log_day", root)
    return f"{root}/*/*/*/*.gz"


def _new_database(spark: SparkSession) -> LogDatabase:
    run_id = uuid.uuid4().hex
    location = f"{scratch_dir(spark)}/hitledger-{run_id}/warehouse"
    return LogDatabase(spark, location, f"hitledger_{run_id}")


# The databases below are loaded once per session and data set, which a name of its own makes
# safe only as long as the files at a path stay as they are.


@_once
def _database(spark: SparkSession, sf_dir: str) -> LogDatabase:
    """The five tables, loaded from the archive by the batch load."""
    lines = text_logs.scan_lines(spark, _archive(spark, sf_dir))
    database = _new_database(spark)
    batch.run(lines, database)
    return database


@_once
def _loaded_twice(spark: SparkSession, sf_dir: str) -> LogDatabase:
    """The same lines appended two times."""
    database = _new_database(spark)
    for _ in range(2):
        batch.run(_lines(spark, sf_dir), database)
    return database


@_once
def _loaded_in_halves(spark: SparkSession, sf_dir: str) -> LogDatabase:
    """Two appends of other lines each, with rankings of ten; the second refreshes in part."""
    database = _new_database(spark)
    for half in range(2):
        lines = _lines(spark, sf_dir).where(F.col("event_id") % 2 == half)
        batch.run(lines, database, LoadOptions(top_n=10))
    return database


@_once
def _loaded_again(spark: SparkSession, sf_dir: str) -> LogDatabase:
    """A load that lacks some rows of one day, and then that day replaced.

    Lines with an offset are not among them, as their rows may belong to the next day.
    """
    day = text_logs.parse_day(DAY)
    archive, database = _archive(spark, sf_dir), _new_database(spark)
    of_day = (F.col("log_day") == F.lit(day)) & ~(F.col("event_id") % 31).isin(5, 6)
    lacking = of_day & (F.col("event_id") % 3 > 0)
    batch.run(_lines(spark, sf_dir).where(~lacking), database)
    around = text_logs.scan_around_days(spark, archive, [day], hive_layout=True)
    batch.run(around, database, LoadOptions(mode="replace", replace_days=(day,)))
    return database


@_once
def _loaded_by_files(spark: SparkSession, sf_dir: str) -> tuple[LogDatabase, newfiles.NewFilesReport]:
    """New files appended twice, dropped lines kept, and one file written anew in between."""
    archive, database = _archive(spark, sf_dir), _new_database(spark)
    options = LoadOptions(keep_dropped=True)
    newfiles.append_new_files(database, archive, options)
    listed = newfiles.text_logs.list_files(spark, archive).orderBy("path").first()
    grown = [{**listed.asDict(), "bytes": listed["bytes"] - 1}]  # as if it had been shorter then
    newfiles.record_files(database, grown)
    return database, newfiles.append_new_files(database, archive, options)


@_once
def _emptied(spark: SparkSession, sf_dir: str) -> LogDatabase:
    """All lines, and then some days replaced by input that has none of theirs."""
    database = _new_database(spark)
    lines = _lines(spark, sf_dir)
    batch.run(lines, database)
    days = tuple(dt.date.fromisoformat(day) for day in EMPTIED)
    elsewhere = lines.where(~F.col("log_day").between(days[0] - dt.timedelta(1), days[-1] + dt.timedelta(1)))
    batch.run(elsewhere, database, LoadOptions(mode="replace", replace_days=days))
    return database


@_once
def _compacted(spark: SparkSession, sf_dir: str) -> LogDatabase:
    """The rows of several loads, their files put together."""
    database = _new_database(spark).create()
    logs = _database(spark, sf_dir).table(ACCESS_LOGS)
    for part in range(4):
        writers.append(logs.where(F.pmod(F.xxhash64(*logs.columns), F.lit(4)) == part), database, ACCESS_LOGS)
    compaction.compact(database, ACCESS_LOGS)
    return database


@_once
def _summarized(spark: SparkSession, sf_dir: str) -> LogDatabase:
    """The loaded tables, with traffic and addresses per day."""
    database = _database(spark, sf_dir)
    upkeep.summarize(database)
    return database


def _stored(spark: SparkSession, sf_dir: str, spec: TableSpec) -> DataFrame:
    return _database(spark, sf_dir).table(spec)


def _on_lines(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(_lines(spark, sf_dir))


def _on_logs(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(_logs(spark, sf_dir))


def _on_table(spec: TableSpec, report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: _comparable(report(_stored(spark, sf_dir, spec)))


def _scan_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_logs.scan_lines(spark, _archive(spark, sf_dir))


def _scan_one_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = text_logs.parse_day(DAY)
    return text_logs.scan_one_day(spark, _archive(spark, sf_dir), day, hive_layout=True)


def _url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    url = F.col("url")
    of_pages = pages.select(
        "url",
        derived.url_path(url).alias("url_path"),
        derived.file_extension(url).alias("file_extension"),
    )
    logs = _logs(spark, sf_dir).select("url", "url_path", "file_extension")
    return logs.unionByName(of_pages)


def _week_bounds(logs: DataFrame) -> DataFrame:
    monday = derived.week_start(F.col("date"))
    return (
        logs.select("date", "year", "week_of_year")
        .distinct()
        .select(
            "date",
            "year",
            "week_of_year",
            monday.alias("week_start_date"),
            derived.week_end(monday).alias("week_end_date"),
            derived.iso_week_year(F.col("date")).alias("iso_year"),
        )
    )


def _table_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.table_row_counts(_database(spark, sf_dir).tables())


def _load_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with and without a load time that lies in the life of the session, per table."""
    stamp = F.col("processed_timestamp")
    begun = F.timestamp_millis(F.lit(spark.sparkContext.startTime))
    good = F.coalesce(stamp.between(begun, F.current_timestamp()), F.lit(False))
    counts = [
        table.agg(
            F.count_if(good).alias("rows_with_time"), F.count_if(~good).alias("rows_without")
        ).select(F.lit(name).alias("table_name"), "*")
        for name, table in _database(spark, sf_dir).tables().items()
    ]
    return reduce(DataFrame.unionByName, counts)


def _append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = _loaded_twice(spark, sf_dir)
    rows = database.table(ACCESS_LOGS).groupBy("date").agg(F.count("*").alias("rows_of_day"))
    return _comparable(database.table(DAILY_TOP_IPS)).join(rows, "date")


def _latest_top(spec: TopTableSpec, load: Callable[[SparkSession, str], LogDatabase]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        database = load(spark, sf_dir)
        return reports.latest_top(database.table(spec), spec.item, database.days(spec))

    return query


def _with_days(report: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    """A report on the rows and the listed days of ``access_logs``."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        database = _database(spark, sf_dir)
        return report(database.table(ACCESS_LOGS), database.days(ACCESS_LOGS))

    return query


def _rejects_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines without a row, the reason, and the day of the directory their file is in."""
    lines = text_logs.scan_lines_by_file(spark, _archive(spark, sf_dir))
    parts = [F.regexp_extract("file_path", f"/{key}=([0-9]+)/", 1) for key in text_logs.DAY_KEYS]
    return parsing.dropped_lines(lines).select(
        F.concat_ws("-", *parts).alias("file_day"), "value", "reason"
    )


def _bad_time_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    dropped = parsing.dropped_lines(_lines(spark, sf_dir))
    return dropped.where(F.col("reason") == "time").drop("reason")


def _line_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines, those of either reason to drop them, and the rows of the loaded table."""
    lines = _lines(spark, sf_dir)
    dropped = parsing.dropped_lines(lines).agg(
        F.count_if(F.col("reason") == "pattern").alias("bad_format"),
        F.count_if(F.col("reason") == "time").alias("bad_time"),
    )
    kept = _stored(spark, sf_dir, ACCESS_LOGS).agg(F.count("*").alias("rows_kept"))
    read = lines.agg(F.count("*").alias("lines_read"))
    return read.select(
        "lines_read",
        *[dropped.select(name).scalar().alias(name) for name in dropped.columns],
        kept.scalar().alias("rows_kept"),
    )


def _replace_to_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per day, and both device rankings, after days were replaced by nothing."""
    database = _emptied(spark, sf_dir)
    rank = F.col("rank")
    rows = database.table(ACCESS_LOGS).groupBy("date").agg(F.count("*").alias("n"))
    nothing = F.lit(None).cast("string").alias("device_type")
    days = rows.select(F.lit("rows").alias("what"), F.col("date").alias("first_day"), nothing, "n", F.lit(0).alias("rank"))
    for what, spec, day in (("day", DAILY_TOP_DEVICES, "date"), ("week", WEEKLY_TOP_DEVICES, "week_start_date")):
        top = database.table(spec)
        days = days.unionByName(
            top.select(F.lit(what).alias("what"), F.col(day).alias("first_day"), "device_type",
                       F.col("request_count").alias("n"), rank)
        )
    return days


def _append_new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    database, second = _loaded_by_files(spark, sf_dir)
    rows = database.table(ACCESS_LOGS).groupBy("date").agg(F.count("*").alias("rows_of_day"))
    return rows.select(
        "*",
        F.lit(len(second.new_files)).cast("long").alias("new_files_left"),
        F.lit(len(second.changed_files)).cast("long").alias("changed_files"),
    )


def _compacted_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = _compacted(spark, sf_dir)
    rows = database.table(ACCESS_LOGS).groupBy("date").agg(
        F.count("*").alias("rows_of_day"), F.sum("response_size").cast("double").alias("bytes_sent")
    )
    return rows.join(compaction.file_sizes(database, ACCESS_LOGS).select("date", "files"), "date")


def _from_summaries(report: Callable[..., DataFrame], *args, days: bool = False) -> Query:
    """A report on traffic and addresses per day; no row of the logs is read."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        database = _summarized(spark, sf_dir)
        listed = [database.days(ACCESS_LOGS)] if days else []
        return report(database.table(DAILY_TRAFFIC), database.table(DAILY_ADDRESSES), *listed, *args)

    return query


# Statements as a user types them, on the tables of the database in use.
SQL_TEXTS = {
    "sql_daily_traffic": f"""
        SELECT date, COUNT(*) AS requests, COUNT(DISTINCT ip_address) AS unique_ips,
               AVG(response_size) AS avg_response_size
        FROM {{logs}} WHERE date >= DATE '{SINCE}' GROUP BY date ORDER BY date""",
    "sql_device_share": f"""
        SELECT device_type, COUNT(*) AS requests, COUNT(DISTINCT ip_address) AS unique_ips
        FROM {{logs}}
        WHERE date BETWEEN DATE '{SINCE}' AND DATE '{LAST}' AND NOT COALESCE(is_bot, FALSE)
        GROUP BY device_type ORDER BY requests DESC, device_type""",
    "sql_weekly_leaders": """
        SELECT year, week_of_year, ip_address, request_count
        FROM {weekly} WHERE rank = 1 ORDER BY year, week_of_year""",
}


def _sql_text(text: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        database = _database(spark, sf_dir)
        names = {"logs": ACCESS_LOGS.name, "weekly": WEEKLY_TOP_IPS.name}
        return spark.sql(text.format(**{k: database.qualified(v) for k, v in names.items()}))

    return query


def entry(spark: SparkSession) -> DataFrame:
    """Five busiest addresses of every day."""
    return topn.top_requests(_logs(spark, "/root/testdata/sf0.001"), DAILY_TOP_IPS)


def access_log_queries() -> dict[str, Query]:
    named: dict[str, Query] = {
        "format_lines": _lines,
        "scan_lines": _scan_lines,
        "scan_one_day": _scan_one_day,
        "parse_lines": _on_lines(parsing.parse_lines),
        "reject_lines": _on_lines(parsing.rejected_lines),
        "parse_funnel": _on_lines(parsing.parse_funnel),
        "parse_timestamps": _on_logs(lambda logs: logs.select("ip_address", "timestamp")),
        "classify_devices": _on_logs(lambda logs: logs.select("user_agent", "device_type")),
        "calendar_columns": _on_logs(
            lambda logs: logs.select(
                "timestamp", "date", "hour", "year", "month", "day", "week_of_year"
            )
        ),
        "status_category": _on_logs(lambda logs: logs.select("status_code", "status_category")),
        "url_parts": _url_parts,
        "bot_flag": _on_logs(lambda logs: logs.select("user_agent", "is_bot")),
        "enrich_logs": _logs,
        "week_bounds": _on_logs(_week_bounds),
        "daily_ip_counts": _on_logs(lambda logs: topn.daily_counts(logs, "ip_address")),
        "daily_device_counts": _on_logs(lambda logs: topn.daily_counts(logs, "device_type")),
        "weekly_ip_counts": _on_logs(lambda logs: topn.weekly_counts(logs, "ip_address")),
        "weekly_device_counts": _on_logs(lambda logs: topn.weekly_counts(logs, "device_type")),
    }
    for spec in TOP_TABLES:
        named[spec.name] = _on_logs(lambda logs, spec=spec: topn.top_requests(logs, spec))
    named.update(
        {
            "pipeline_access_logs": _on_table(ACCESS_LOGS, lambda logs: logs),
            "table_row_counts": _table_row_counts,
            "date_range": _with_days(lambda logs, days: reports.date_range(days)),
            "data_range_summary": _with_days(reports.data_range_summary),
            "recent_daily_summary": _with_days(reports.recent_daily_summary),
            "daily_traffic": _on_table(
                ACCESS_LOGS, lambda logs: reports.daily_traffic(logs, SINCE)
            ),
            "device_traffic": _on_table(
                ACCESS_LOGS, lambda logs: reports.device_traffic(logs, SINCE, LAST)
            ),
            "status_breakdown": _on_table(
                ACCESS_LOGS, lambda logs: reports.status_breakdown(logs, SINCE)
            ),
            "hour_slice": _on_table(
                ACCESS_LOGS, lambda logs: reports.hour_slice(logs, DAY, FIRST_HOUR, LAST_HOUR)
            ),
            "latest_daily_top_ips": _latest_top(DAILY_TOP_IPS, _database),
            "latest_daily_top_devices": _latest_top(DAILY_TOP_DEVICES, _database),
            "latest_daily_top_ips_10": _latest_top(DAILY_TOP_IPS, _loaded_in_halves),
            "weekly_report": _on_table(
                WEEKLY_TOP_IPS,
                lambda top: reports.top_by_week(top, "ip_address", int(SINCE[:4]), int(LAST[:4])),
            ),
            "weekly_top_ips_iso": _on_logs(
                lambda logs: topn.top_requests(logs, WEEKLY_TOP_IPS, week_year="iso")
            ),
            "append_twice": _append_twice,
            "refresh_touched": lambda spark, sf_dir: _comparable(
                _loaded_in_halves(spark, sf_dir).table(WEEKLY_TOP_IPS)
            ),
            "replace_one_day": lambda spark, sf_dir: _comparable(
                _loaded_again(spark, sf_dir).table(ACCESS_LOGS)
            ),
            "replace_to_empty": _replace_to_empty,
            "append_new_files": _append_new_files,
            "stored_request_counts": lambda spark, sf_dir: _loaded_in_halves(spark, sf_dir).table(REQUEST_COUNTS),
            "kept_dropped_lines": lambda spark, sf_dir: _loaded_by_files(spark, sf_dir)[0]
            .table(DROPPED_LINES)
            .drop("file_path"),
            "compacted_days": _compacted_days,
            "scan_large_files": lambda spark, sf_dir: text_logs.scan_lines(
                spark, _archive(spark, sf_dir), spread_above=SPREAD_ABOVE
            ),
            "kept_data_range_summary": _from_summaries(summaries.data_range_summary, days=True),
            "kept_recent_daily_summary": _from_summaries(summaries.recent_daily_summary, days=True),
            "kept_daily_traffic": _from_summaries(summaries.traffic_by_day, SINCE),
            "kept_device_traffic": _from_summaries(summaries.traffic_by_device, SINCE, LAST),
            "kept_status_breakdown": _from_summaries(
                lambda traffic, _, since: summaries.status_breakdown(traffic, since), SINCE
            ),
            "load_times": _load_times,
            "rejects_by_file": _rejects_by_file,
            "bad_time_lines": _bad_time_lines,
            "line_accounts": _line_accounts,
            **{f"stored_{spec.name}": _on_table(spec, lambda top: top) for spec in TOP_TABLES},
            **{name: _sql_text(text) for name, text in SQL_TEXTS.items()},
            "top_ips_on_day": _on_table(DAILY_TOP_IPS, lambda top: reports.top_on_day(top, DAY)),
        }
    )
    return named


def _with_package(query: Query) -> Query:
    """Let the Python workers of a session that is already there import this repository."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        variables = spark.sparkContext.environment
        before = variables.get("PYTHONPATH", "")
        if ROOT not in before.split(os.pathsep):
            variables["PYTHONPATH"] = os.pathsep.join(filter(None, (ROOT, before)))
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    named = access_log_queries()
    if llm is not None:
        texts = {**llm.queries(), "pipeline": corpus_pipeline.run}
        named.update({name: _with_package(query) for name, query in texts.items()})
    return named


def oracle_sql() -> dict[str, str]:
    statements = access_log_sql.statements(DAY, SINCE, LAST, EMPTIED)
    if llm is not None:
        statements.update(llm.oracle_sql())
        if corpus_pipeline.ORACLE_SQL:
            statements["pipeline"] = corpus_pipeline.ORACLE_SQL
    return statements
