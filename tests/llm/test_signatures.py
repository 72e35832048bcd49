"""Signature search against scores of every document, and its bounds against exact scores."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np

from hitledger.llm import signatures
from tests import compare

SCHEMA = "doc_id long, text string, item int, score string, key int"


def terms_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def plain(rows, items, k):
    counted = [(key, Counter(terms_of(text))) for key, text in rows]
    counted = [(key, found) for key, found in counted if found]
    N, L = len(counted), sum(sum(found.values()) for _, found in counted)
    df = Counter(term for _, found in counted for term in found)
    out = []
    for item, text in items:
        scores = []
        for key, found in counted:
            m = 50 + 50 * sum(found.values()) * N // L
            score = 0
            for term in set(terms_of(text)) & set(found):
                w = math.floor(1000 * math.log((2 * N + 2) / (2 * df[term] + 1)))
                score += w * (10**9 * found[term] // (1000 * found[term] + 20 * m))
            if score > 0:
                scores.append((-score, key is None, key))
        out += [(item, rank, key, -s) for rank, (s, _, key) in enumerate(sorted(scores)[:k], 1)]
    return out


def odd_rows():
    chance = random.Random(5)
    vocabulary = [f"w{i}" for i in range(80)] + ["É", "é", "漢字", "A", "a", "a_b", "x-1", "\x85"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    text = lambda n: " ".join(chance.choices(vocabulary, weights, k=n))
    rows = [(i, text(chance.choice([1, 3, 20, 60, 400]))) for i in range(500)]
    rows += [rows[3]] * 70 + [(None, text(30)), (None, text(30)), (501, None), (502, ""), (503, "!? ..")]
    rows += [(3, text(50)), (504, "w1 " * 30_000 + text(20_000)), (505, " ".join(f"z{i}" for i in range(9000)))]
    items = [(i, text(8)) for i in range(30)] + [(30, None), (31, "?"), (32, "nowhere at all"), (5, "w70 w71")]
    items += [(None, "w2 w2 É"), (33, "w0"), (34, "z17 z18 w79")]
    return rows, items


def test_search_on_odd_rows(spark, monkeypatch):
    rows, items = odd_rows()
    df = spark.createDataFrame([(*row, 1, "x", 2) for row in rows], SCHEMA).repartition(5)
    sought = spark.createDataFrame([(*row, "x") for row in items], "item_id int, text string, rank string")
    order = lambda found: sorted(found, key=str)
    got = signatures.search(df, sought, k=7)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert order(map(tuple, got.collect())) == order(plain(rows, items, 7))
    monkeypatch.setattr(signatures, "PASS_TERMS", 60)
    monkeypatch.setattr(signatures, "CHUNK_TERMS", 5)
    monkeypatch.setattr(signatures, "BROADCAST_KEYS", 0)
    got = signatures.search(df, sought, k=50, index=signatures.build_index(df))
    assert order(map(tuple, got.collect())) == order(plain(rows, items, 50))
    for documents, wanted in ((df.limit(0), sought), (df, sought.limit(0)), (df.where("doc_id > 500 and doc_id < 504"), sought)):
        empty = signatures.search(documents, wanted)
        assert empty.collect() == [] and empty.columns == got.columns


def test_bounds_are_never_below_scores_and_mostly_close():
    rows, items = odd_rows()
    counted = [Counter(terms_of(text)) for _, text in rows if terms_of(text)]
    texts = [text.encode() for _, text in rows if terms_of(text)]
    sizes, owner, hashes, counts = signatures.term_counts(texts)
    assert list(sizes) == [sum(found.values()) for found in counted]
    block = signatures.Block(1024)
    for i in range(200):
        _, terms, levels = signatures.entries_of(hashes[owner == i], counts[owner == i])
        bits = signatures.bit_positions(terms, levels, np.full(len(terms), 1024))
        block.add(i, int(sizes[i]), hashes[owner == i], bits.ravel())
    row = block.row()
    terms = np.unique(hashes[owner < 200])
    weights = np.arange(1, len(terms) + 1)
    chance = random.Random(2)
    wanted = [np.array(sorted(chance.sample(range(len(terms)), 12))) for _ in range(20)]
    query = signatures.Query(terms, weights, wanted, len(texts), int(sizes.sum()))
    bounds = query.bounds(1024, sizes[:200], row["slices"])
    norms = query.norms(sizes)
    exact = np.array([[query.exact(q, hashes[owner == i], counts[owner == i], int(norms[i])) for i in range(200)] for q in range(20)])
    assert (bounds >= exact).all()
    assert (bounds == exact).mean() > 0.5 and bounds.sum() < 1.3 * exact.sum()


def test_few_documents_are_scored_exactly(spark):
    """On the documents the bounds leave out nearly all of them."""
    documents = spark.read.parquet(f"{compare.testdata('sf0.01')}/documents.parquet")
    index = signatures.build_index(documents)
    blocks = [r.asDict() for r in index.collect()]
    assert sum(len(r["keys"]) for r in blocks) == documents.where("text rlike '[A-Za-z]'").count()
    text_bytes = documents.selectExpr("sum(octet_length(text))").first()[0]
    assert sum(len(r["slices"]) for r in blocks) < text_bytes
