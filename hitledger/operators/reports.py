"""Summaries and ad-hoc reports over stored tables.

Each takes the table as a DataFrame and reads only the columns and date partitions it
needs. Distinct counts are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def _rows() -> Column:
    return F.count(F.lit(1))


def _addresses() -> Column:
    return F.count_distinct("ip_address")


def date_range(days: DataFrame) -> DataFrame:
    """First and last of the days and their number; ``LogDatabase.days`` opens no data file."""
    return days.agg(
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        F.count_distinct("date").alias("total_days"),
    )


def data_range_summary(logs: DataFrame, days: DataFrame) -> DataFrame:
    """Range of days, addresses and mean size of the whole table.

    The days come from the catalog; addresses and sizes need the rows. With both distinct
    counts in one aggregate Spark would copy every row once per distinct column.
    """
    found = date_range(days).select(F.struct("*")).scalar()
    totals = logs.agg(
        _addresses().alias("unique_ips"), F.avg("response_size").alias("avg_response_size")
    )
    return totals.select(
        found.getField("min_date").alias("earliest_date"),
        found.getField("max_date").alias("latest_date"),
        found.getField("total_days").alias("total_days"),
        "unique_ips",
        "avg_response_size",
    )


def recent_daily_summary(
    logs: DataFrame, listed: DataFrame, days: int = 300, limit: int = 20
) -> DataFrame:
    """The newest ``limit`` days no older than ``days`` before the newest one.

    The first day to report comes from the listed days, ``LogDatabase.days``, so only the
    partitions of the reported days are read.
    """
    newest = listed.select("date").distinct().orderBy(F.desc("date")).limit(limit)
    first_day = newest.agg(F.greatest(F.min("date"), F.date_sub(F.max("date"), days)))
    return (
        logs.where(F.col("date") >= first_day.scalar())
        .groupBy("date")
        .agg(
            _rows().alias("total_requests"),
            _addresses().alias("unique_ips"),
            F.round(F.avg("response_size"), 2).alias("avg_response_size"),
            F.count_if(F.col("status_code") >= 400).alias("error_count"),
        )
        .orderBy(F.desc("date"))
        .limit(limit)
    )


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its name and number of rows."""
    counts = [
        table.agg(_rows().alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, table in tables.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result


def daily_traffic(logs: DataFrame, since: str) -> DataFrame:
    return (
        logs.where(F.col("date") >= F.lit(since).cast("date"))
        .groupBy("date")
        .agg(
            _rows().alias("requests"),
            _addresses().alias("unique_ips"),
            F.avg("response_size").alias("avg_response_size"),
        )
        .orderBy("date")
    )


def device_traffic(logs: DataFrame, first: str, last: str) -> DataFrame:
    return (
        logs.where(F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
        .groupBy("device_type")
        .agg(_rows().alias("requests"), _addresses().alias("unique_users"))
        .orderBy(F.desc("requests"), "device_type")
    )


def status_breakdown(logs: DataFrame, since: str) -> DataFrame:
    """Requests per status with their share of all, in percent with two places.

    The share is rounded half up on whole numbers. The total is a window over the
    grouped rows, of which there are at most a few thousand status values.
    """
    counts = (
        logs.where(F.col("date") >= F.lit(since).cast("date"))
        .groupBy("status_category", "status_code")
        .agg(_rows().alias("count"))
        .withColumn("total", F.sum("count").over(Window.partitionBy()))
    )
    hundredths = F.expr("(20000 * count + total) div (2 * total)")
    return counts.select(
        "status_category",
        "status_code",
        "count",
        (hundredths.cast("double") / 100).alias("percentage"),
    ).orderBy(F.desc("count"), "status_category", "status_code")


def latest_top(top: DataFrame, item: str, days: DataFrame) -> DataFrame:
    """Ranking of the newest of the days in a daily top-N table, as wide as it is stored."""
    newest = days.agg(F.max("date")).scalar()
    return (
        top.where(F.col("date") == newest)
        .select("date", item, "request_count", "rank")
        .orderBy("rank")
    )


def top_on_day(top: DataFrame, day: str) -> DataFrame:
    """One day of a daily top-N table, most requests first."""
    return top.where(F.col("date") == F.lit(day).cast("date")).orderBy(
        F.desc("request_count"), "rank"
    )


def top_by_week(top: DataFrame, item: str, first_year: int, last_year: int) -> DataFrame:
    """Weekly rankings of some years, by year, week and rank; reads their partitions only."""
    return (
        top.where(F.col("year").between(first_year, last_year))
        .select("year", "week_of_year", "week_start_date", "week_end_date", item, "request_count", "rank")
        .orderBy("year", "week_of_year", "rank")
    )


def hour_slice(logs: DataFrame, day: str, first_hour: int, last_hour: int) -> DataFrame:
    """All columns of one day between two hours, both included."""
    return logs.where(
        (F.col("date") == F.lit(day).cast("date"))
        & F.col("hour").between(first_hour, last_hour)
    )
