"""Replaced days without rows, tables that are already there, and what is kept per day."""

from __future__ import annotations

import datetime as dt
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from hitledger.operators import reports, summaries, topn
from hitledger.plans import batch, upkeep
from hitledger.plans.batch import LoadOptions
from hitledger.schemas import (
    ACCESS_LOGS,
    ADDRESS_NUMBERS,
    DAILY_ADDRESSES,
    DAILY_TOP_IPS,
    DAILY_TRAFFIC,
    REQUEST_COUNTS,
    WEEKLY_TOP_DEVICES,
    WEEKLY_TOP_IPS,
)
from hitledger.sinks import writers
from hitledger.sinks.audit import AuditError
from hitledger.sinks.catalog import LogDatabase, SchemaError
from tests.compare import plan
from tests.test_pipeline import database, line, lines_of, ordered, rows_of, stored  # noqa: F401

def day(number: int) -> str:
    return f"{number:02d}/Jan/2025"


def january(number: int) -> dt.date:
    return dt.date(2025, 1, number)


def dates(database, spec=ACCESS_LOGS):
    return sorted({row["date"] for row in database.table(spec).select("date").collect()})


def counts(database):
    return ordered(database.table(REQUEST_COUNTS).collect())


def recounted(database):
    logs = database.table(ACCESS_LOGS)
    return ordered(summaries.request_counts(logs, upkeep.ITEMS).select("date", "kind", "item", "request_count").collect())


def test_days_replaced_by_nothing(spark, database):
    texts = [line(day(n), f"1.1.1.{n}") for n in (5, 6, 7, 12, 20)]
    batch.run(lines_of(spark, texts), database, LoadOptions(summaries=True))
    days = tuple(january(n) for n in (5, 6, 7, 8))
    again = lines_of(spark, [line(day(5), "9.9.9.9")])
    options = LoadOptions(mode="replace", replace_days=days, summaries=True)
    report = batch.run(again, database, options)
    assert (report.days, report.emptied) == ([january(5)], [january(6), january(7)])
    assert dates(database) == dates(database, DAILY_TOP_IPS) == [january(n) for n in (5, 12, 20)]
    assert [row[:2] for row in rows_of(database, DAILY_TOP_IPS)][0] == (january(5), "9.9.9.9")
    assert dates(database, DAILY_TRAFFIC) == dates(database, DAILY_ADDRESSES) == dates(database)
    assert counts(database) == recounted(database)
    # the week of 6 to 12 January has its last day left, and then nothing
    weeks = [(row[3], row[4]) for row in rows_of(database, WEEKLY_TOP_IPS)]
    assert weeks == [(1, "9.9.9.9"), (2, "1.1.1.12"), (4, "1.1.1.20")]
    report = batch.run(lines_of(spark, []), database, LoadOptions(mode="replace", replace_days=(january(12),)))
    assert (report.days, report.emptied, report.rows_enriched) == ([], [january(12)], 0)
    assert [row[3] for row in rows_of(database, WEEKLY_TOP_DEVICES)] == [1, 4]
    assert {tuple(row) for row in database.partitions(WEEKLY_TOP_IPS).collect()} == {(2025, 1), (2025, 4)}
    # a fresh catalog finds no files of them either
    again = LogDatabase(spark, database.location, database.name + "_again").create()
    assert stored(again) == stored(database)
    # and everything can go
    batch.run(lines_of(spark, []), database, LoadOptions(mode="replace", replace_days=(january(5), january(20))))
    assert all(rows == [] for rows in stored(database).values()) and counts(database) == []


def test_empty_days_can_be_refused(spark, database):
    batch.run(lines_of(spark, [line(day(5)), line(day(6))]), database)
    before = stored(database)
    options = LoadOptions(mode="replace", replace_days=(january(5), january(6), january(9)), empty_days="refuse")
    with pytest.raises(AuditError, match="no rows for 2025-01-06, 2025-01-09"):
        batch.run(lines_of(spark, [line(day(5), "9.9.9.9")]), database, options)
    assert stored(database) == before
    with pytest.raises(ValueError):
        LoadOptions(empty_days="keep")


def test_a_load_reads_the_rows_of_its_own_days_only(spark, database, monkeypatch):
    batch.run(lines_of(spark, [line(day(n), f"1.1.1.{n % 3}") for n in range(5, 15)]), database)
    plans = []
    inserted = writers._insert

    def watched(df, *rest, **named):
        plans.append(plan(df))
        return inserted(df, *rest, **named)

    monkeypatch.setattr(writers, "_insert", watched)
    batch.run(lines_of(spark, [line(day(7), "1.1.1.9")] * 3), database)
    scans = [text for text in plans if f"{ACCESS_LOGS.name}" in "".join(re.findall("Scan parquet (.*)", text))
             and "staged_" not in "".join(re.findall("Scan parquet (.*)", text))]
    assert scans, "the counts of the day come from its rows"
    for text in scans:
        read = set(re.findall(r"2025-01-\d\d", " ".join(re.findall(r"PartitionFilters: \[(.*)\]", text))))
        assert read == {"2025-01-07"}
    partial = stored(database)
    batch.refresh(database)
    assert stored(database) == partial and counts(database) == recounted(database)


def test_counts_that_are_missing_are_made(spark, database):
    """A load that died after publishing, and a table from before counts were kept."""
    batch.run(lines_of(spark, [line(day(6)), line(day(7), "2.2.2.2")]), database)
    upkeep.invalidate(database, [january(6)])
    assert upkeep.counted_days(database) == {january(7)}
    batch.run(lines_of(spark, [line(day(8))]), database)
    assert counts(database) == recounted(database)
    spark.sql(f"DROP TABLE {database.qualified(REQUEST_COUNTS.name)}")
    want = stored(database)
    batch.refresh(database, days=[january(8)])
    assert stored(database) == want
    assert ordered(topn.top_requests(database.table(ACCESS_LOGS), WEEKLY_TOP_IPS).collect()) == want["weekly_top_ips"]


def altered(spark, database, columns, keys="`date` date"):
    spark.sql(f"CREATE DATABASE `{database.name}` LOCATION '{database.location}'")
    spark.sql(
        f"CREATE TABLE {database.qualified(ACCESS_LOGS.name)} ({columns}, {keys}) USING parquet"
        f" PARTITIONED BY ({keys.split()[0]}) LOCATION '{database.path(ACCESS_LOGS)}'"
    )


def test_a_table_with_columns_in_another_order(spark, database):
    names = [f for f in ACCESS_LOGS.schema if f.name not in ("date", "method", "url", "hour")]
    columns = ["`url` string", "`note` string", "`method` string"] + [f"`{f.name}` {f.dataType.simpleString()}" for f in names]
    altered(spark, database, ", ".join(reversed(columns)))
    batch.run(lines_of(spark, [line(day(5))]), database)
    days = (january(5), january(6))
    batch.run(lines_of(spark, [line(day(n)) for n in (5, 6)]), database, LoadOptions(mode="replace", replace_days=days))
    rows = database.table(ACCESS_LOGS).collect()
    assert {(row.method, row.url, row.status_code, row.hour) for row in rows} == {("GET", "/a.css", 200, 10)}
    whole = spark.table(database.qualified(ACCESS_LOGS.name))
    assert len(rows) == 2 and {row.note for row in whole.collect()} == {None}
    assert database.table(ACCESS_LOGS).columns == ACCESS_LOGS.columns


@pytest.mark.parametrize(("columns", "keys", "fault"), [
    ("`status_code` string", "`date` date", "status_code is string, not int"),
    ("`date` date", "`day` int", "partitioned by"),
    ("`ip_address` string", "`date` string", "date is string, not date"),
])
def test_a_table_that_cannot_hold_the_rows_is_refused(spark, database, columns, keys, fault):
    altered(spark, database, columns, keys)
    with pytest.raises(SchemaError, match=fault):
        batch.run(lines_of(spark, [line(day(5))]), database)
    assert spark.table(database.qualified(ACCESS_LOGS.name)).count() == 0


def test_old_files_lack_a_new_column(spark, database):
    """A table of an older version: its rows stay, with NULL in what it did not have."""
    database.create()
    batch.run(lines_of(spark, [line(day(5))]), database)
    old = database.table(ACCESS_LOGS).drop("is_bot", "hour")
    path = f"{database.location}/older/{ACCESS_LOGS.name}"
    old.write.partitionBy("date").parquet(path)
    older = LogDatabase(spark, f"{database.location}/older", database.name + "_older")
    spark.sql(f"CREATE DATABASE `{older.name}` LOCATION '{older.location}'")
    spark.sql(f"CREATE TABLE {older.qualified(ACCESS_LOGS.name)} USING parquet LOCATION '{path}'")
    spark.catalog.recoverPartitions(older.qualified(ACCESS_LOGS.name))
    batch.run(lines_of(spark, [line(day(6))]), older)
    assert [(row.hour, row.is_bot) for row in older.table(ACCESS_LOGS).orderBy("date").collect()] == [(None, None), (10, False)]


ADDRESSES = ["0.0.0.0", "255.255.255.255", "1.2.3.4", "01.2.3.4", "1.2.3.4.5", "256.1.1.1", "::1", "fe80::1", "host", "1.2.3", "0.0.0.1", "-"]


def test_numbers_of_addresses(spark):
    df = spark.createDataFrame([(a,) for a in ADDRESSES], "ip_address string")
    got = {r[0]: r[1] for r in df.select("ip_address", summaries.ipv4_number(F.col("ip_address"))).collect()}
    assert {a for a in got if got[a] is not None} == {"0.0.0.0", "0.0.0.1", "1.2.3.4", "255.255.255.255"}
    assert got["1.2.3.4"] == 0x01020304 and got["255.255.255.255"] == 2**32 - 1 and got["0.0.0.0"] == 0


def test_summaries_equal_the_rows(spark, database):
    texts = [line(day(5 + i % 4), ADDRESSES[(i * i) % 12], agent="Firefox" if i % 3 else "curl") for i in range(60)]
    batch.run(lines_of(spark, texts), database)
    for more in ([], [line(day(8), "other-host"), line(day(9), "::1"), line(day(9), "9.9.9.9")]):
        if more:
            batch.run(lines_of(spark, more), database, LoadOptions(summaries=True))
        else:
            upkeep.summarize(database)
        logs, traffic, addresses = (database.table(spec) for spec in (ACCESS_LOGS, DAILY_TRAFFIC, DAILY_ADDRESSES))
        days = database.days(ACCESS_LOGS)
        first, last = "2025-01-05", "2025-01-09"
        pairs = [
            (summaries.data_range_summary(traffic, addresses, days), reports.data_range_summary(logs, days)),
            (summaries.recent_daily_summary(traffic, addresses, days), reports.recent_daily_summary(logs, days)),
            (summaries.traffic_by_day(traffic, addresses, "2025-01-06"), reports.daily_traffic(logs, "2025-01-06")),
            (summaries.traffic_by_device(traffic, addresses, first, last), reports.device_traffic(logs, first, last)),
            (summaries.status_breakdown(traffic, first), reports.status_breakdown(logs, first)),
        ]
        for kept, whole in pairs:
            assert kept.columns == whole.columns
            assert list(map(tuple, kept.collect())) == list(map(tuple, whole.collect()))
            assert f"/{ACCESS_LOGS.name}" not in plan(kept)
    numbers = database.table(ADDRESS_NUMBERS).collect()
    assert len({row.number for row in numbers}) == len({row.ip_address for row in numbers}) == len(numbers) == 4
    assert min(row.number for row in numbers) >= summaries.FIRST_OTHER


def test_dropped_partitions_leave_no_files(spark, database):
    batch.run(lines_of(spark, [line(day(5)), line(day(6))]), database)
    database.drop_partitions(REQUEST_COUNTS, [(january(5),)])
    database.drop_partitions(REQUEST_COUNTS, [(january(6), "device_type"), (january(7), "none")])
    database.drop_partitions(REQUEST_COUNTS, [])
    assert [(row.date, row.kind) for row in database.table(REQUEST_COUNTS).collect()] == [(january(6), "ip_address")]
    left = Path(database.path(REQUEST_COUNTS)).rglob("*.parquet")
    assert {path.parent.name for path in left} == {"kind=ip_address"}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_week_keys():
    days = [dt.date(2024, 12, 30), dt.date(2025, 1, 1), dt.date(2025, 1, 6)]
    assert batch.week_keys(days) == [(2024, 1), (2025, 1), (2025, 2)]
    assert batch.week_keys(days, "iso") == [(2025, 1), (2025, 2)]
