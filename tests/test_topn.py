"""Top-N ranking and week grouping."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hitledger.operators import topn
from hitledger.schemas import DAILY_TOP_IPS, WEEKLY_TOP_IPS

DAY = dt.date(2025, 1, 5)


def log_rows(spark, rows):
    """Rows of (date, ip) with the calendar columns the weekly counts need."""
    df = spark.createDataFrame(rows, "date date, ip_address string")
    return df.withColumns({"year": F.year("date"), "week_of_year": F.weekofyear("date")})


def test_ties_go_by_address_and_days_are_apart(spark):
    counts = {"a": 3, "b": 2, "c": 2, "d": 1, "e": 1, "f": 1}
    rows = [(DAY, ip) for ip, n in counts.items() for _ in range(n)]
    rows += [(DAY + dt.timedelta(1), ip) for ip in ("y", "x")]
    top = topn.top_requests(log_rows(spark, rows), DAILY_TOP_IPS).orderBy("date", "rank")
    got = [(row.date.day, row.ip_address, row.request_count, row["rank"]) for row in top.collect()]
    assert got == [
        (5, "a", 3, 1), (5, "b", 2, 2), (5, "c", 2, 3), (5, "d", 1, 4), (5, "e", 1, 5),
        (6, "x", 1, 1), (6, "y", 1, 2),
    ]


def test_calendar_year_weeks_mix_both_ends_of_a_year(spark):
    rows = [(dt.date(2024, 1, 3), "a"), (dt.date(2024, 12, 30), "a"), (dt.date(2025, 1, 1), "a")]
    logs = log_rows(spark, rows)
    mixed = topn.top_requests(logs, WEEKLY_TOP_IPS).collect()
    assert sorted((r.year, r.week_of_year, r.week_start_date.isoformat(), r["rank"]) for r in mixed) == [
        (2024, 1, "2024-01-01", 1), (2024, 1, "2024-12-30", 2), (2025, 1, "2024-12-30", 1),
    ]
    iso = topn.top_requests(logs, WEEKLY_TOP_IPS, week_year="iso").collect()
    assert sorted((r.year, r.week_of_year, r.request_count) for r in iso) == [
        (2024, 1, 1), (2025, 1, 2),
    ]


def test_one_address_with_a_third_of_all_rows(spark):
    ids = spark.range(30000)
    logs = ids.select(
        F.lit(DAY).alias("date"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 5000).cast("string")).alias(
            "ip_address"
        ),
    )
    top = topn.top_requests(logs, DAILY_TOP_IPS).orderBy("rank").collect()
    assert (top[0].ip_address, top[0].request_count) == ("hot", 10000)
    assert len(top) == 5


def test_arguments(spark):
    logs = log_rows(spark, [(DAY, "a")])
    with pytest.raises(ValueError):
        topn.top_requests(logs, DAILY_TOP_IPS, n=0)
    with pytest.raises(ValueError):
        topn.weekly_counts(logs, "ip_address", "fiscal")
