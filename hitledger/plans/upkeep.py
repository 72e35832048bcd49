"""Keeps the tables that are derived from the rows of a day in step with ``access_logs``.

A load first drops the derived partitions of the days it changes, then publishes rows, then makes
those partitions anew. So a partition that is there is up to date, whenever a load is killed,
and what is to be done is the days of ``access_logs`` that a derived table lacks. Both lists come
from the catalog, and only those days' rows are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date

from pyspark.sql import DataFrame, functions as F

from hitledger.operators import summaries
from hitledger.schemas import (
    ACCESS_LOGS,
    ADDRESS_NUMBERS,
    DAILY_ADDRESSES,
    DAILY_TRAFFIC,
    DERIVED_BY_DAY,
    REQUEST_COUNTS,
    TOP_TABLES,
    TableSpec,
)
from hitledger.sinks import writers
from hitledger.sinks.catalog import LogDatabase

#: Columns of ``access_logs`` whose values are counted per day.
ITEMS = list(dict.fromkeys(spec.item for spec in TOP_TABLES))


def listed_days(database: LogDatabase, spec: TableSpec) -> set[date]:
    """Days of the partitions of a table, from the catalog."""
    if not database.exists(spec):
        return set()
    return {row["date"] for row in database.partitions(spec).select("date").distinct().collect()}


def counted_days(database: LogDatabase) -> set[date]:
    """Days whose requests are counted for every item."""
    if not database.exists(REQUEST_COUNTS):
        return set()
    whole = database.partitions(REQUEST_COUNTS).groupBy("date").count().where(F.col("count") >= len(ITEMS))
    return {row["date"] for row in whole.collect()}


def rows_of_days(logs: DataFrame, days: Iterable[date] | None) -> DataFrame:
    return logs if days is None else logs.where(F.col("date").isin(sorted(days)))


def invalidate(database: LogDatabase, days: Iterable[date]) -> None:
    """Drop what is derived from days that are about to change."""
    days = set(days)
    for spec in DERIVED_BY_DAY:
        if database.exists(spec):
            database.drop_partitions(spec, [(day,) for day in days & listed_days(database, spec)])


def _make(
    database: LogDatabase, spec: TableSpec, days: set[date] | None, rows: Callable[[DataFrame], DataFrame]
) -> None:
    """Overwrite the partitions of the days, and drop those of days that have no rows any more."""
    present = listed_days(database, ACCESS_LOGS)
    wanted = present if days is None else days & present
    if wanted:
        logs = rows_of_days(database.table(ACCESS_LOGS), None if days is None else wanted)
        writers.overwrite_partitions({spec: rows(logs)}, database)
    gone = listed_days(database, spec) - present
    database.drop_partitions(spec, [(day,) for day in gone])


def recount(database: LogDatabase, days: set[date] | None) -> None:
    """Count the requests of the days (None: of all) per item, from their rows."""
    database.create([REQUEST_COUNTS])
    _make(database, REQUEST_COUNTS, days, lambda logs: summaries.request_counts(logs, ITEMS))


def number_addresses(database: LogDatabase, logs: DataFrame) -> None:
    """Give every address of the rows that is not IPv4 a number of its own, if it has none.

    Numbers are unique, not dense: each task takes them from a range of its own.
    """
    database.create([ADDRESS_NUMBERS])
    known = database.table(ADDRESS_NUMBERS)
    last = known.agg(F.max("number"), F.max("run")).first()
    begin = summaries.FIRST_OTHER if last[0] is None else last[0] + 1
    new = summaries.other_addresses(logs).join(known, "ip_address", "left_anti")
    name = database.new_staging_name(ADDRESS_NUMBERS)
    try:
        numbered = new.select(
            F.lit((last[1] or 0) + 1).cast("int").alias("run"),
            "ip_address",
            (F.monotonically_increasing_id() + begin).alias("number"),
        )
        writers.stage(numbered, database, ADDRESS_NUMBERS, name)
        writers.append(database.spark.table(database.qualified(name)), database, ADDRESS_NUMBERS)
    finally:
        writers.drop_staged(database, name)


def summarize(database: LogDatabase, days: Iterable[date] | None = ()) -> None:
    """Bring traffic and addresses per day up to date.

    Days that are not summarized yet are, and ``days`` again; with None all days are. One load
    or summary may run at a time, as two would give out the same numbers.
    """
    database.create([ACCESS_LOGS, DAILY_TRAFFIC, DAILY_ADDRESSES, ADDRESS_NUMBERS])
    present = listed_days(database, ACCESS_LOGS)
    for spec in (DAILY_TRAFFIC, DAILY_ADDRESSES):
        todo = None if days is None else (present - listed_days(database, spec)) | set(days)
        if spec is DAILY_TRAFFIC:
            _make(database, spec, todo, summaries.daily_traffic)
            continue
        if todo is None or todo & present:
            number_addresses(database, rows_of_days(database.table(ACCESS_LOGS), todo))
        numbers = database.table(ADDRESS_NUMBERS)
        _make(database, spec, todo, lambda logs: summaries.daily_addresses(logs, numbers))
