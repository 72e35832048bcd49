"""Secret findings against plain patterns, the forest on labels, and edge cases."""

from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import Observation, functions as F

from hitledger.llm import secrets
from tests import compare

SCHEMA = "doc_id long, text string, source string, key string, value string, found int"


def plain(text: str) -> set:
    """(start, end, value) by Python's re; runs and assignments apart."""
    found = set()
    given = re.compile(rf"(?i:{secrets.NAMES})[\"']? ?[=:] ?[\"']?([^\s\"']{{6,}})")
    for m in given.finditer(text):
        found.add((m.start(1), m.end(1), m.group(1)))
    before = re.compile(rf"(?i:{secrets.NAMES})[\"']? ?[=:] ?[\"']?$")
    for m in re.finditer(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}", text):
        if re.search("[0-9]", m.group()) and not before.search(text[: m.start()]):
            found.add((m.start(), m.end(), m.group()))
    return found


def hashed(values: set) -> set:
    return {(a, b, hashlib.sha256(v.encode()).hexdigest()) for a, b, v in values}


def found_in(df) -> dict:
    by: dict = {}
    for r in df.collect():
        by.setdefault(r["doc_id"], set()).add((r["start"], r["end"], r["value_sha256"]))
    return by


def test_documents_agree(spark):
    documents = spark.read.parquet(f"{compare.testdata('sf0.01')}/documents.parquet")
    found = secrets.scan_secrets(documents)
    assert "Python" not in compare.plan(found)
    want = {r["doc_id"]: hashed(plain(r["text"])) for r in documents.collect()}
    assert found_in(found) == {key: spans for key, spans in want.items() if spans}
    by_kind = {(r["kind"], r["kept"]): r["n"] for r in found.groupBy("kind", "kept").agg(F.count("*").alias("n")).collect()}
    assert by_kind["assigned", True] > 0 and by_kind["key", False] > 0


def test_scan_in_a_session_that_observed(spark, tmp_path):
    """Every load of the other part observes a query; the forest must still reach the tasks."""
    seen = Observation()
    spark.range(5).observe(seen, F.count("*").alias("n")).write.parquet(f"{tmp_path}/observed")
    assert seen.get == {"n": 5}
    documents = spark.read.parquet(f"{compare.testdata('sf0.01')}/documents.parquet")
    assert secrets.scan_secrets(documents).where("score IS NOT NULL").count() > 0


def test_forest_learns_from_labels(spark):
    chance = random.Random(7)
    signs = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    words = "user name data file path table count page style title border color".split()
    rows, labels = [], []
    for i in range(240):
        if i % 2:
            value = "".join(chance.choice(signs) for _ in range(24)) + "7"
        else:
            value = "_".join(chance.choice(words) for _ in range(5)) + "_1"
        rows.append((i, f"some text {value} more", "src/main", "k", "v", 1))
        if i < 160:
            labels.append((i, 10, 10 + len(value), i % 2))
    df = spark.createDataFrame(rows, SCHEMA)
    marks = spark.createDataFrame(labels, "doc_id long, start int, end int, label int")
    got = {r["doc_id"]: r["kept"] for r in secrets.scan_secrets(df, labels=marks).collect()}
    held_out = [got[i] == bool(i % 2) for i in range(160, 240)]
    assert sum(held_out) / len(held_out) > 0.95


def test_edge_cases(spark):
    key = "AKIA" + "ABCD2345EFGH6789"
    rows = [
        (1, None, None), (2, "", "x"), (3, f"é {key}.", "x"), (3, f"é {key}.", "x"),
        (4, "password = 'hunter2x9' and token: short", None), (None, f"{key} 1234567890123456", "x"),
        (5, "1" * 100_000 + " " + "a" * 100_000 + " " + "secret" * 20_000, "x"),
    ]
    df = spark.createDataFrame([(*row, "k", "v", 1) for row in rows], SCHEMA)
    got = secrets.scan_secrets(df).collect()
    assert len([r for r in got if r["doc_id"] == 3]) == 2
    assert {(r["start"], r["end"]) for r in got if r["doc_id"] == 3} == {(2, 22)}
    assert {(r["start"], r["end"]) for r in got if r["doc_id"] == 4} == {(12, 21)}
    assert {(r["start"], r["end"]) for r in got if r["doc_id"] is None} == {(0, 20), (21, 37)}
    assert not [r for r in got if r["doc_id"] in (1, 2)] and len([r for r in got if r["doc_id"] == 5]) == 1
    assert secrets.scan_secrets(df.limit(0)).collect() == []
    alone = secrets.scan_secrets(df.where("doc_id = 3"), path=None).collect()
    assert [(r["score"], r["kept"]) for r in alone] == [(None, True)] * 2


def test_long_values_are_whole(spark):
    chance = random.Random(3)
    signs = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"
    values = ["".join(chance.choice(signs) for _ in range(n)) for n in (199, 200, 201, 1000, 8000)]
    values.append(".".join(["eyJ" + value for value in values[2:]]))  # as a JWT is made
    rows = [(i, f'x token="{value}" y', "src/main", "k", "v", 1) for i, value in enumerate(values)]
    rows.append((9, "password=" + "a1" * 500_000, "src/main", "k", "v", 1))
    got = [r for r in secrets.scan_secrets(spark.createDataFrame(rows, SCHEMA)).collect() if r["kind"] == "assigned"]
    want = {i: hashed({(9, 9 + len(value), value)}) for i, value in enumerate(values)}
    assert {r["doc_id"]: {(r["start"], r["end"], r["value_sha256"])} for r in got} == {
        **want, 9: hashed({(9, 1_000_009, "a1" * 500_000)}),
    }


def test_the_dictionary_is_the_corpus_s_own(spark, monkeypatch):
    texts = ["Alpha beta beta, gamma", "alpha BETA x1delta", "alpha beta", "alpha gamma delta", None, "", "gamma g4 al"]
    df = spark.createDataFrame([(i, text, None, "k", "v", 1) for i, text in enumerate(texts)], SCHEMA)
    assert secrets.dictionary(df) == ["alpha", "beta", "gamma"]
    monkeypatch.setattr(secrets, "DICTIONARY_WORDS", 1)
    assert secrets.dictionary(df) == ["alpha"] and secrets.dictionary(df.limit(0)) == []
    values = spark.createDataFrame([("alphaBeta_7GAMMA-x",), ("9911",), ("ALPHAbeta",)], "value string")
    got = [r[0] for r in values.select(secrets.covered(F.col("value"), ["alpha", "beta", "gamma"])).collect()]
    assert got == [14, 0, 9]
    assert [r[0] for r in values.select(secrets.covered(F.col("value"), [])).collect()] == [0, 0, 0]
