"""Registered text queries against their SQL, and the operators behind them on odd rows."""

from __future__ import annotations

import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from hitledger.llm import registry, sharding, topk
from tests import compare

SF = compare.testdata("sf0.001")


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF)


@pytest.mark.parametrize("name", registry.oracle_sql())
def test_query_agrees_with_sql(spark, duck, name):
    df, sql = registry.queries()[name](spark, SF), registry.oracle_sql()[name]
    assert not compare.type_differences(df, duck, sql)
    got = compare.spark_rows(df)
    assert got == compare.duckdb_rows(duck, sql) and sum(got[1].values()) > 0


def test_top_k_on_odd_vectors(spark):
    chance = random.Random(2)
    vectors = [(i, [chance.choice([-1.0, 0.5, 2.0]) for _ in range(3)], i, "x") for i in range(60)]
    vectors += [(60, None, 1, "x"), (61, [1.0, None, 2.0], 1, "x"), (62, [math.nan] * 3, 1, "x")]
    vectors += [(63, [math.inf, 1.0, 1.0], 1, "x"), (None, [1.0] * 3, 1, "x"), (80, [1.0], 1, "x")]
    vectors += [(20, [2.0, 2.0, 2.0], 1, "x"), (21, [2.0, 2.0, 2.0], 1, "x")]
    vectors += [(20, vectors[20][1], 1, "x"), (100, [], 1, "x"), (101, [], 1, "x")]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>, v int, score string")
    good = [(i, v) for i, v, *_ in vectors if i is not None and i not in (60, 61, 62, 63)]
    want = []
    for at, (q, vector) in enumerate(good):
        if q % 20 == 0:
            whole = [math.floor(64 * x) for x in vector]
            found = sorted(
                (-sum(a * math.floor(64 * b) for a, b in zip(whole, v)), i)
                for place, (i, v) in enumerate(good) if place != at and len(v) == len(whole)
            )
            want += [(q, rank, i, -s) for rank, (s, i) in enumerate(found[:7], 1)]
    for fragments in (1, 2, 3):
        got = topk.top_k(df, F.col("vec_id") % 20 == 0, k=7, fragments=fragments).collect()
        assert sorted(tuple(r) for r in got) == sorted(want)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []


def test_top_k_over_many_blocks(spark, monkeypatch):
    embeddings = spark.read.parquet(f"{SF}/embeddings.parquet")
    whole = topk.top_k(embeddings, F.col("vec_id") % 5 == 0).collect()
    monkeypatch.setattr(topk, "BLOCK_ROWS", 37)
    monkeypatch.setattr(topk, "SLICE_QUERIES", 5)
    assert sorted(topk.top_k(embeddings, F.col("vec_id") % 5 == 0).collect()) == sorted(whole)


def test_sums_beyond_doubles_are_exact(spark):
    rows = [(0, [1e8, 3.0]), (1, [4e6, 1.0]), (2, [4e6, 2.0]), (3, [-1e8, 1e8])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["score"] for r in topk.top_k(df, F.col("vec_id") == 0).collect()}
    a = [64 * 10**8, 192]
    assert got[1] == a[0] * 64 * 4 * 10**6 + a[1] * 64 and got[2] - got[1] == a[1] * 64


def test_shards_of_odd_rows(spark):
    rows = [(i % 50, "é" * (i % 7), "x", 1) for i in range(900)] + [(None, None, "x", 1)] * 5
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string, slot int")
    got = sharding.shard_records(df, [1.0, 2.0, 0.0, 1.0], [1.0, 2.0, 0.0, 1.0, 3.0]).collect()
    assert len(got) == len(rows)
    assert {r["shard"] for r in got} <= {0, 1, 3}
    assert all(r["grown_shard"] in (r["shard"], 4) for r in got)
    for shard in {r["shard"] for r in got}:
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert len({r["shard"] for r in got if r["doc_id"] is None}) == 1
    assert all(r["size"] == 1 for r in got if r["doc_id"] is None)
    crc = {(r["size"], r["text_crc32"]) for r in got}
    assert crc == {(2 * n + 1, zlib.crc32(("é" * n).encode())) for n in range(7)}
    assert sharding.shard_records(df.limit(0), [1.0]).collect() == []
    with pytest.raises(ValueError):
        sharding.rendezvous_shard(F.col("doc_id"), [0.0])


def test_shares_follow_weights(spark):
    shard = sharding.rendezvous_shard(F.col("id"), [1.0, 3.0])
    counts = {r["s"]: r["n"] for r in spark.range(8000).groupBy(shard.alias("s")).agg(F.count("*").alias("n")).collect()}
    assert abs(counts[1] / 8000 - 0.75) < 0.02
