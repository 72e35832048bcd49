"""What is kept per day, and the reports that need nothing else.

Requests per item, traffic per device and status, and the addresses as bitmaps of numbers.
Bitmaps merge: the addresses of several days or devices are the OR of their bitmaps, so distinct
counts stay exact without a look at the rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from hitledger.operators.reports import date_range
from hitledger.operators.topn import daily_counts

#: IPv4 addresses are numbered by value; the numbers of all others begin here.
FIRST_OTHER = 1 << 32
_BYTE = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_IPV4 = rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"


def request_counts(logs: DataFrame, items: list[str]) -> DataFrame:
    """Requests per day and item, for several columns; each scan reads one of them."""
    counted = [
        daily_counts(logs, item).select(
            "date", F.lit(item).alias("kind"), F.col(item).alias("item"), "request_count"
        )
        for item in items
    ]
    return reduce(DataFrame.unionByName, counted)


def counts_of_item(counts: DataFrame, item: str) -> DataFrame:
    """The stored counts of one column, as ``daily_counts`` gives them."""
    return counts.where(F.col("kind") == item).select("date", F.col("item").alias(item), "request_count")


def daily_traffic(logs: DataFrame) -> DataFrame:
    """Requests, requests with a size, and bytes per day, device and status."""
    return logs.groupBy("date", "device_type", "status_category", "status_code").agg(
        F.count(F.lit(1)).alias("requests"),
        F.count("response_size").alias("sized_requests"),
        F.sum(F.col("response_size").cast("decimal(20,0)")).cast("decimal(38,0)").alias("bytes"),
    )


def ipv4_number(address: Column) -> Column:
    """Value of an IPv4 address in its usual form, or NULL; no two texts have one value."""
    parts = F.split(address, r"\.")
    value = reduce(lambda n, i: n * 256 + F.get(parts, F.lit(i)).try_cast("bigint"), range(4), F.lit(0).cast("bigint"))
    return F.when(address.rlike(_IPV4), value)


def other_addresses(logs: DataFrame) -> DataFrame:
    """Distinct addresses that are not IPv4: these need a stored number."""
    others = logs.where(F.col("ip_address").isNotNull() & ~F.col("ip_address").rlike(_IPV4))
    return others.select("ip_address").distinct()


def daily_addresses(logs: DataFrame, numbers: DataFrame) -> DataFrame:
    """Bitmaps of the address numbers per day and device.

    ``numbers``: ``ip_address`` and ``number`` of all addresses that are not IPv4. Repeated
    addresses of a day go before the join and before the bitmaps are filled.
    """
    seen = logs.where("ip_address IS NOT NULL").select("date", "device_type", "ip_address").distinct()
    own = ipv4_number(F.col("ip_address"))
    known = numbers.select("ip_address", F.col("number").alias("stored_number"))
    by_value = seen.withColumn("number", own).where("number IS NOT NULL").drop("ip_address")
    by_table = (
        seen.where(own.isNull()).join(known, "ip_address").withColumnRenamed("stored_number", "number")
    ).drop("ip_address")
    number = F.col("number")
    return (
        by_value.unionByName(by_table)
        .groupBy("date", "device_type", F.bitmap_bucket_number(number).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("numbers"))
    )


def distinct_addresses(addresses: DataFrame, *by: str) -> DataFrame:
    """Exact number of addresses per group, from the bitmaps alone."""
    merged = addresses.groupBy(*by, "bucket").agg(F.bitmap_or_agg("numbers").alias("numbers"))
    counted = merged.groupBy(*by) if by else merged
    return counted.agg(F.coalesce(F.sum(F.bitmap_count("numbers")), F.lit(0)).alias("addresses"))


def _mean_size() -> Column:
    total, count = F.sum("bytes").cast("double"), F.sum("sized_requests")
    return F.when(count > 0, total / count)


def _requests() -> Column:
    return F.sum("requests").alias("requests")


def data_range_summary(traffic: DataFrame, addresses: DataFrame, days: DataFrame) -> DataFrame:
    found = date_range(days).select(F.struct("*")).scalar()
    unique = distinct_addresses(addresses).scalar()
    return traffic.agg(_mean_size().alias("avg_response_size")).select(
        found.getField("min_date").alias("earliest_date"),
        found.getField("max_date").alias("latest_date"),
        found.getField("total_days").alias("total_days"),
        unique.alias("unique_ips"),
        "avg_response_size",
    )


def recent_daily_summary(
    traffic: DataFrame, addresses: DataFrame, listed: DataFrame, days: int = 300, limit: int = 20
) -> DataFrame:
    newest = listed.select("date").distinct().orderBy(F.desc("date")).limit(limit)
    first_day = newest.agg(F.greatest(F.min("date"), F.date_sub(F.max("date"), days))).scalar()
    errors = F.sum(F.when(F.col("status_code") >= 400, F.col("requests")).otherwise(0))
    totals = traffic.where(F.col("date") >= first_day).groupBy("date").agg(
        F.sum("requests").alias("total_requests"),
        F.round(_mean_size(), 2).alias("avg_response_size"),
        errors.alias("error_count"),
    )
    unique = distinct_addresses(addresses.where(F.col("date") >= first_day), "date")
    return (
        totals.join(unique, "date")
        .select("date", "total_requests", F.col("addresses").alias("unique_ips"), "avg_response_size", "error_count")
        .orderBy(F.desc("date"))
        .limit(limit)
    )


def traffic_by_day(traffic: DataFrame, addresses: DataFrame, since: str) -> DataFrame:
    first = F.col("date") >= F.lit(since).cast("date")
    totals = traffic.where(first).groupBy("date").agg(_requests(), _mean_size().alias("avg_response_size"))
    unique = distinct_addresses(addresses.where(first), "date")
    return (
        totals.join(unique, "date")
        .select("date", "requests", F.col("addresses").alias("unique_ips"), "avg_response_size")
        .orderBy("date")
    )


def traffic_by_device(traffic: DataFrame, addresses: DataFrame, first: str, last: str) -> DataFrame:
    inside = F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    totals = traffic.where(inside).groupBy("device_type").agg(_requests())
    unique = distinct_addresses(addresses.where(inside), "device_type")
    return (
        totals.join(unique, "device_type")
        .select("device_type", "requests", F.col("addresses").alias("unique_users"))
        .orderBy(F.desc("requests"), "device_type")
    )


def status_breakdown(traffic: DataFrame, since: str) -> DataFrame:
    counts = (
        traffic.where(F.col("date") >= F.lit(since).cast("date"))
        .groupBy("status_category", "status_code")
        .agg(F.sum("requests").alias("count"))
        .withColumn("total", F.sum("count").over(Window.partitionBy()))
    )
    hundredths = F.expr("(20000 * count + total) div (2 * total)")
    return counts.select(
        "status_category", "status_code", "count", (hundredths.cast("double") / 100).alias("percentage")
    ).orderBy(F.desc("count"), "status_category", "status_code")
