"""Hard negatives against all scores, and the scan's bounds on hard cases."""

from __future__ import annotations

import math
import random

import numpy as np
from pyspark.sql import functions as F

from hitledger.llm import bond

SCHEMA = "vec_id long, embedding array<double>, label int, row string, id int, dims int"


def plain(rows, k=3, n=4, low=30, high=90, scale=256):
    good = [
        (key, [math.floor(scale * x) for x in v], label) for key, v, label in rows
        if key is not None and label is not None and v is not None
        and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a, (key, v, label) in enumerate(good):
        if key % 10:
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(v, w)), i, mark == label)
            for b, (i, w, mark) in enumerate(good) if a != b and len(v) == len(w)
        )
        for ps, p, same in [s for s in scored if s[2]][:k]:
            inside = [(i, -s) for s, i, other in scored if not other and low * -ps <= 100 * -s <= high * -ps]
            out += [(key, p, rank, i, -ps, s) for rank, (i, s) in enumerate(inside[:n], 1)]
    return out


def odd_rows(values):
    chance = random.Random(4)
    rows = [(i, [values(chance) for _ in range(11)], chance.randrange(4)) for i in range(400)]
    rows += [(i, [values(chance) for _ in range(3)], i % 2) for i in range(400, 440)]
    rows += [rows[20]] * 3 + [(20, rows[21][1], 1), (30, rows[31][1], None), (50, None, 1), (None, rows[1][1], 1)]
    rows += [(60, [1.0, None] + [0.5] * 9, 1), (70, [math.nan] * 11, 1), (80, [math.inf] * 11, 1)]
    return rows + [(90, [], 1), (91, [], 1), (92, [], 2), (500, [1.0], 3), (110, [0.0] * 11, 2)]


def test_negatives_of_odd_rows(spark, monkeypatch):
    for values in (lambda c: c.gauss(0.1, 0.2), lambda c: c.choice([-1.0, 0.5, 2.0])):
        rows = odd_rows(values)
        df = spark.createDataFrame([(*row, "x", 1, 2) for row in rows], SCHEMA).repartition(3)
        got = bond.hard_negatives(df, F.col("vec_id") % 10 == 0, 3, 4)
        assert sorted(map(tuple, got.collect())) == sorted(plain(rows))
    monkeypatch.setattr(bond, "BLOCK_ROWS", 64)
    monkeypatch.setattr(bond, "ANCHOR_ROWS", 7)
    monkeypatch.setattr(bond, "STEP", 2)
    got = bond.hard_negatives(df, F.col("vec_id") % 10 == 0, 3, 4)
    assert sorted(map(tuple, got.collect())) == sorted(plain(rows))
    nothing = bond.hard_negatives(df.limit(0), F.col("vec_id") % 10 == 0)
    assert nothing.collect() == [] and nothing.columns == got.columns


def test_scan_keeps_what_matters_and_drops_the_rest():
    chance = np.random.default_rng(1)
    columns = chance.integers(-300, 300, (40, 2000)).astype(float)
    columns[:, :60] = np.round(columns[:, :1] * chance.uniform(0.2, 1.2, 60))  # some that stand out
    lows, highs = columns.min(axis=1), columns.max(axis=1)
    anchor = columns[:, 0]
    whole = (anchor @ columns).astype(np.int64)
    looked = []

    def counted(keep):
        def look(lower, upper):
            looked.append(len(lower))
            return keep(lower, upper)
        return look

    live, scores = bond.vertical_scan(anchor, columns, lows, highs, np.arange(2000), counted(bond.keep_best(5)))
    assert (scores == whole[live]).all() and set(np.argsort(-whole, kind="stable")[:5]) <= set(live)
    assert looked[-1] < 100 < looked[0] == 2000
    best = int(whole.max())
    window = bond.window_of(best, 30, 90)
    live, scores = bond.vertical_scan(anchor, columns, lows, highs, np.arange(2000), bond.keep_in_windows([window], 4))
    inside = np.flatnonzero((whole >= window[0]) & (whole <= window[1]))
    assert set(inside[np.argsort(-whole[inside], kind="stable")[:4]]) <= set(live) and len(live) < 100


def test_windows_and_large_numbers(spark):
    assert bond.window_of(7, 30, 90) == (3, 6) and bond.window_of(0, 30, 90) == (0, 0)
    least, most = bond.window_of(-10, 30, 90)
    assert least > most
    rows = [(0, [4e6, 3.0], 1), (1, [4e6, 1.0], 1), (2, [2e6, 2.0], 2), (3, [-1e6, 1e6], 2), (5, [3e6, 7.0], 3)]
    df = spark.createDataFrame([(*row, "x", 1, 2) for row in rows], SCHEMA)
    got = bond.hard_negatives(df, F.col("vec_id") % 10 == 0, 3, 4)
    assert sorted(map(tuple, got.collect())) == sorted(plain(rows)) != []
