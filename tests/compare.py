"""Compare every query with its SQL on DuckDB: python tests/compare.py [sf] [query ...]"""

from __future__ import annotations

import contextlib
import io
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


def testdata(sf: str) -> str:
    return f"/root/testdata/{sf}"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _value(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return value


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(_value(v) for v in row) for row in df.select(*names).collect())


def duckdb_rows(connection, sql: str) -> tuple[list[str], Counter]:
    result = connection.sql(sql)
    names = sorted(result.columns)
    at = [result.columns.index(name) for name in names]
    return names, Counter(tuple(_value(row[i]) for i in at) for row in result.fetchall())


# DuckDB type for each Spark type the results have.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "date": "DATE",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def type_differences(df, connection, sql: str) -> list[str]:
    result = connection.sql(sql)
    theirs = dict(zip(result.columns, (str(t) for t in result.types)))
    ours = {name: TYPES.get(kind, kind) for name, kind in df.dtypes}
    return [f"{n}: {ours[n]} != {theirs.get(n)}" for n in ours if ours[n] != theirs.get(n)]


def plan(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def main(sf: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from tests.conftest import new_session

    spark = new_session()
    connection = connect(testdata(sf))
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        df = queries[name](spark, testdata(sf))
        got = spark_rows(df)
        seconds = time.time() - start
        if name not in oracle:
            print(f"--  {name:26s} {sum(got[1].values()):7d} rows {seconds:6.2f}s, no SQL")
            continue
        start = time.time()
        want = duckdb_rows(connection, oracle[name])
        duckdb_seconds = time.time() - start
        types = type_differences(df, connection, oracle[name])
        same = got == want and not types
        bad += not same
        print(
            f"{'ok ' if same else 'BAD'} {name:26s} {sum(got[1].values()):7d} rows"
            f" {seconds:6.2f}s, DuckDB {duckdb_seconds:6.2f}s"
        )
        if not same:
            print("   ", got[0], want[0], types)
            print("    only Spark ", list((got[1] - want[1]).items())[:3])
            print("    only DuckDB", list((want[1] - got[1]).items())[:3])
    return bad


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    sys.exit(main(sf, sys.argv[2:]))
