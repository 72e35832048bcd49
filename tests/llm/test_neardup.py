"""Near duplicates against the comparison of every pair."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from hitledger.llm import neardup, tables
from hitledger.llm.components import components
from tests import compare
from tests.llm import plain

SCHEMA = "doc_id long, text string, node string, set_key int"


def as_dict(df) -> dict:
    return {row["doc_id"]: (row["n_shingles"], row["component_id"], row["kept"]) for row in df.collect()}


def cloud(seed: int, copies: int, edits: int, words: int = 120) -> list[str]:
    """Copies of one text with a few words replaced, so that links chain through the group."""
    chance = random.Random(seed)
    base = [f"w{chance.randrange(10**6)}" for _ in range(words)]
    made = []
    for _ in range(copies):
        copy = list(base)
        for _ in range(chance.randrange(edits)):
            copy[chance.randrange(words)] = f"x{chance.randrange(10**6)}"
        made.append(" ".join(copy))
    return made


def test_documents_agree_with_all_pairs(spark):
    documents = spark.read.parquet(f"{compare.testdata('sf0.01')}/documents.parquet")
    rows = [(row["doc_id"], row["text"]) for row in documents.collect()]
    got = as_dict(neardup.near_duplicates(documents, words=3, similarity="0.85"))
    assert got == plain.near_duplicates(rows, 3, "0.85")
    assert sum(not kept for _, _, kept in got.values()) > 20


@pytest.mark.parametrize("block", [1024, 50])
def test_large_groups_agree_with_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    texts = cloud(1, 250, 9) + cloud(2, 120, 14) + cloud(3, 30, 3, words=4)
    random.Random(4).shuffle(texts)
    rows = list(enumerate(texts))
    df = spark.createDataFrame([(i, text, "x", 1) for i, text in rows], SCHEMA)
    got = as_dict(neardup.near_duplicates(df))
    assert got == plain.near_duplicates(rows, 5, "0.8")


def test_edge_cases(spark):
    long = " ".join(f"n{i}" for i in range(200_000))
    rows = [
        (1, "one two"), (2, "ONE\ttwo\n"), (3, None), (4, ""), (5, " \x0b"), (6, "É é"),
        (7, "é é"), (8, long), (9, long + " more"), (10, "a b c d e"), (10, "a b c d e"),
        (12, "one two"),
    ]
    df = spark.createDataFrame([(*row, "x", 1) for row in rows], SCHEMA)
    got = neardup.near_duplicates(df).collect()
    assert len(got) == len(rows)
    assert {row["doc_id"]: row["component_id"] for row in got} == {
        1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 6, 7: 7, 8: 8, 9: 8, 10: 10, 12: 12,
    }
    nameless = spark.createDataFrame([(None, "a b c", "x", 1), (None, "a b c", "x", 1)], SCHEMA)
    assert [(r["component_id"], r["kept"]) for r in neardup.near_duplicates(nameless).collect()] == [
        (None, True), (None, True),
    ]
    assert neardup.near_duplicates(df.limit(0)).collect() == []


def test_components(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, 9), (9, 7), (3, 3), (9, 200)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 100 for i in range(100, 161)}, 7: 7, 9: 7, 200: 7}


def test_estimate_is_corrected_for_chance(spark):
    import numpy as np

    chance = np.random.default_rng(5)
    shared, rest = chance.integers(0, 2**63, 4000, dtype=np.uint64), chance.integers(
        0, 2**63, 2000, dtype=np.uint64
    )
    sets = [np.concatenate((shared, rest[:1000])), np.concatenate((shared, rest[1000:]))]
    fields = [
        np.frombuffer(neardup.packed_fields(neardup.minima(np.sort(s))), dtype=np.uint64) for s in sets
    ]
    estimate = neardup.estimated_similarity(neardup.equal_fields(*fields))
    assert abs(estimate - 4000 / 6000) < 0.16


def test_rows_that_share_an_id_but_not_a_text(spark):
    chance = random.Random(8)

    def words(n: int) -> list[str]:
        return [f"w{chance.randrange(10**6)}" for _ in range(n)]

    texts = {name: words(80) for name in "ABCDE"}
    near = {name: " ".join([*text[:-1], "other"]) for name, text in texts.items()}
    whole = {name: " ".join(text) for name, text in texts.items()}
    hot = [words(40) for _ in range(60)]  # one id over many texts, each with a copy elsewhere
    rows = [
        (5, whole["A"]), (5, whole["B"]), (9, near["B"]),
        (13, whole["C"]), (15, whole["C"]), (15, whole["D"]), (17, near["D"]), (15, ""), (16, ""),
        (21, whole["E"]), (22, near["E"]), (None, whole["A"]),
        *[(30, " ".join(text)) for text in hot],
        *[(100 + i, " ".join([*text[:-1], "other"])) for i, text in enumerate(hot)],
    ]
    want = {5: 5, 9: 5, 13: 13, 15: 13, 16: 16, 17: 13, 21: 21, 22: 21, None: None, 30: 30}
    want |= {100 + i: 30 for i in range(60)}
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame([(*row, "x", 1) for row in order], SCHEMA)
        got = neardup.near_duplicates(df).collect()
        assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in got) == sorted(
            (key or 0, want[key] or 0) for key, _ in rows
        )
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
        left = [r["doc_id"] for r in neardup.without_copies(df).collect()]
        assert sorted(left, key=lambda key: key or 0) == [None, 5, 13, 16, 21, 30]


def test_few_texts_are_moved(spark, monkeypatch):
    moved = []

    def noting(split):
        def noted(*args):
            found = split(*args)
            moved.append((found[1] if isinstance(found, tuple) else found).count())
            return found

        return noted

    for name in ("perhaps_among", "surely_apart"):
        monkeypatch.setattr(neardup, name, noting(getattr(neardup, name)))
    texts = [*cloud(1, 6, 2), *[cloud(100 + i, 1, 1)[0] for i in range(1000)]]
    df = spark.createDataFrame([(i, text, "x", 1) for i, text in enumerate(texts)], SCHEMA)
    left = neardup.without_copies(df.unionByName(df.where("doc_id = 900")))
    assert sorted(r["doc_id"] for r in left.collect()) == [0, *range(6, 1006)]
    assert len(moved) == 2 and all(0 < rows < 40 for rows in moved)


@pytest.mark.parametrize("most", [1 << 27, 1 << 15])
def test_sieve_loses_no_row(spark, monkeypatch, most):
    monkeypatch.setattr(tables, "SIEVE_BITS", most)
    rows = spark.range(-20_000, 20_000).withColumn("id", F.when(F.col("id") != 5, F.col("id")))
    sought, by_id = rows.where("id % 4 = 0 or id is null"), F.xxhash64("id")
    apart, others = tables.surely_apart(rows, by_id, sought, by_id)
    assert apart.columns == others.columns == rows.columns
    assert apart.where("id % 4 = 0 or id is null").isEmpty()
    assert apart.count() + others.count() == 40_000
    assert others.count() < (12_000 if most > 1 << 15 else 20_000)
    assert tables.perhaps_among(rows, by_id, sought, by_id).count() == others.count()
    assert tables.perhaps_among(rows, by_id, sought.limit(0), by_id).isEmpty()
