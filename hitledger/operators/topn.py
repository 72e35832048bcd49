"""Request counts per period and the first N of each period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from hitledger.functions import derived
from hitledger.schemas import TopTableSpec

WEEK_COLUMNS = ("year", "week_of_year", "week_start_date", "week_end_date")


def count_requests(logs: DataFrame, *keys: str | Column) -> DataFrame:
    """Rows per key. Partial counts are taken before the shuffle, so hot keys stay cheap."""
    return logs.groupBy(*keys).agg(F.count(F.lit(1)).alias("request_count"))


def daily_counts(logs: DataFrame, item: str) -> DataFrame:
    return count_requests(logs, "date", item)


def _week_columns(week_year: str) -> list[Column]:
    if week_year not in ("calendar", "iso"):
        raise ValueError(f"week_year must be 'calendar' or 'iso', not {week_year!r}")
    date = F.col("date")
    return [
        (F.year(date) if week_year == "calendar" else derived.iso_week_year(date)).alias("year"),
        F.weekofyear(date).alias("week_of_year"),
        derived.week_start(date).alias("week_start_date"),
    ]


def _with_sunday(counts: DataFrame, item: str) -> DataFrame:
    sunday = derived.week_end(F.col("week_start_date")).alias("week_end_date")
    return counts.select(*WEEK_COLUMNS[:3], sunday, item, "request_count")


def weekly_counts(logs: DataFrame, item: str, week_year: str = "calendar") -> DataFrame:
    """Requests per week and item.

    ``week_year="calendar"`` pairs the ISO week with the calendar year of the day, so
    the days of a week over New Year fall into two groups, and (year, 1) can hold days
    of both ends of a year. ``"iso"`` uses the year the week belongs to.
    """
    return _with_sunday(count_requests(logs, *_week_columns(week_year), item), item)


def weeks_of_days(counts: DataFrame, item: str, week_year: str = "calendar") -> DataFrame:
    """Requests per week and item from requests per day and item."""
    weeks = counts.groupBy(*_week_columns(week_year), item)
    return _with_sunday(weeks.agg(F.sum("request_count").alias("request_count")), item)


def top_n_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column | str], n: int = 5
) -> DataFrame:
    """First ``n`` rows of each group by ``order``, with their ``rank`` from 1.

    ``order`` should be total, so that equal runs give equal ranks. The limit on
    ``row_number`` lets Spark drop all but ``n`` rows of a group in every task before
    the shuffle, so a group of any size leaves each task with ``n`` rows.
    """
    if n < 1:
        raise ValueError(f"n must be at least 1, not {n}")
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("rank", rank).where(F.col("rank") <= n)


def top_of_days(
    counts: DataFrame, table: TopTableSpec, n: int = 5, week_year: str = "calendar"
) -> DataFrame:
    """Rows of one of the top-N tables from requests per day and item, without load time."""
    order = [F.desc("request_count"), table.item]
    if table.weekly:
        counts = weeks_of_days(counts, table.item, week_year)
        order.append("week_start_date")
    columns = [name for name in table.columns if name != "processed_timestamp"]
    return top_n_per_group(counts, table.partition_by, order, n).select(*columns)


def top_requests(
    logs: DataFrame, table: TopTableSpec, n: int = 5, week_year: str = "calendar"
) -> DataFrame:
    """Rows of one of the top-N tables from the rows of the logs."""
    return top_of_days(daily_counts(logs, table.item), table, n, week_year)
