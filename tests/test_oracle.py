"""Every registered query against its SQL on DuckDB."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests import compare

SF = compare.testdata("sf0.001")


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF)


def test_every_query_has_sql():
    assert set(entry.access_log_queries()) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", entry.access_log_queries())
def test_query_agrees(spark, duck, name):
    df = entry.access_log_queries()[name](spark, SF)
    sql = entry.oracle_sql()[name]
    assert not compare.type_differences(df, duck, sql)
    got = compare.spark_rows(df)
    assert got == compare.duckdb_rows(duck, sql)
    assert sum(got[1].values()) > 0
    assert "Python" not in compare.plan(df)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and all(1 <= row["rank"] <= 5 for row in rows)
