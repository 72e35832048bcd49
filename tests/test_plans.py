"""Shapes of the physical plans."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from hitledger.operators import reports, topn
from hitledger.operators.enrich import access_logs
from hitledger.schemas import ACCESS_LOGS, DAILY_TOP_IPS, TOP_TABLES
from tests import compare
from tests.compare import plan

SF = compare.testdata("sf0.001")


def partition_filters(text: str) -> str:
    return " ".join(re.findall(r"PartitionFilters: \[(.*)\]", text))


@pytest.fixture(scope="module")
def logs(spark):
    return entry._database(spark, SF).table(ACCESS_LOGS)


def test_a_line_is_matched_once(spark):
    text = plan(access_logs(entry._lines(spark, SF)))
    calls = [line for line in text.splitlines() if "regexp_replace(" in line]
    assert len(calls) == 1 and calls[0].count("regexp_replace(") == 1
    assert text.count("gettimestamp(") == 1


def test_counting_reads_no_agent(spark):
    text = plan(topn.daily_counts(access_logs(entry._lines(spark, SF)), "ip_address"))
    assert "lower(" not in text and "partial_count" in text


@pytest.mark.parametrize("spec", TOP_TABLES, ids=lambda spec: spec.name)
def test_top_n_is_limited_before_the_shuffle(logs, spec):
    text = plan(topn.top_requests(logs, spec))
    assert text.count("WindowGroupLimit") >= 2 and "Partial" in text and "Final" in text


def test_daily_top_reads_two_columns(logs):
    text = plan(topn.top_requests(logs, DAILY_TOP_IPS))
    assert "ReadSchema: struct<ip_address:string>" in text


def test_day_filter_reaches_the_partitions(logs):
    text = plan(reports.hour_slice(logs, "2025-01-05", 10, 12))
    assert "2025-01-05" in partition_filters(text)
    assert "GreaterThanOrEqual(hour,10)" in text
    assert "2025-01-01" in partition_filters(plan(reports.daily_traffic(logs, "2025-01-01")))


def test_day_filter_goes_through_the_ranking(logs):
    top = topn.top_requests(logs, DAILY_TOP_IPS)
    assert "2025-01-05" in partition_filters(plan(reports.top_on_day(top, "2025-01-05")))


def test_recent_days_prune_by_a_subquery(spark, logs):
    days = entry._database(spark, SF).days(ACCESS_LOGS)
    text = plan(reports.recent_daily_summary(logs, days))
    assert text.count("Scan parquet") == 1 or text.count("ReadSchema") == 1
    assert "Subquery" in partition_filters(text) or "subquery" in partition_filters(text)
    assert "TakeOrderedAndProject" in text


def test_days_are_looked_up_without_files(spark, logs):
    database = entry._database(spark, SF)
    assert "Scan parquet" not in plan(reports.date_range(database.days(ACCESS_LOGS)))
    top = reports.latest_top(database.table(DAILY_TOP_IPS), "ip_address", database.days(DAILY_TOP_IPS))
    assert plan(top).count("ReadSchema") == 1 and "subquery" in partition_filters(plan(top)).lower()


def test_whole_table_summary_copies_no_rows(spark, logs):
    text = plan(reports.data_range_summary(logs, entry._database(spark, SF).days(ACCESS_LOGS)))
    assert "Expand" not in text and text.count("ReadSchema") == 1
