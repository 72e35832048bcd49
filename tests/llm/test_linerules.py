"""Line rules against plain Python on small tables, and the texts that the removal leaves."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

from hitledger.llm import linerules
from tests import compare

SCHEMA = "doc_id long, text string, source string, line string, row int, kept int"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def normal(line):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in line)
    return re.sub("[0-9]+", "0", " ".join(words_of(lower)))


def plain(rows, max_documents=20, one_in=1000):
    """(doc_id, BASE, n_removed, base_failed, kept) of every row, and the texts kept."""
    rows = [(key, text or "", host or "") for key, text, host in rows]
    holders, hosts = defaultdict(set), defaultdict(set)
    for _, text, host in rows:
        hosts[host].add(text)
        for line in text.split("\n"):
            if words_of(line):
                holders[host, normal(line)].add(text)
    often = {k for k, v in holders.items() if len(v) > max_documents and len(v) * one_in > len(hosts[k[0]])}
    out, left = [], []
    for key, text, host in rows:
        words = words_of(text)
        wins = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        times = Counter(wins)
        covered = {i + k for i, win in enumerate(wins) if times[win] > 1 for k in range(3)}
        lines = [line for line in text.split("\n") if words_of(line)]
        gone = sum(len(words_of(line)) for line in lines if (host, normal(line)) in often)
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        kept = not failed and len(words) - gone >= 50 and 100 * gone <= 50 * len(words)
        symbols = sum(text.count(c) for c in "#*$%&|<>")
        base = (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered))
        out.append((key, *base, gone, failed, kept))
        if kept:
            left.append((key, "\n".join(x for x in text.split("\n") if (host, normal(x)) not in often)))
    return out, left


def odd_rows():
    chance = random.Random(11)
    vocabulary = ["é", "Ab", "ab", "1", "22", "x#", "漢字", "a|b", "\x85", "w", " z"] + [f"v{i}x" for i in range(60)]
    common = ["Page 1 of 20", "page  33 OF 4", "All rights reserved", " \tall rights RESERVED"]
    rows = []
    for i in range(300):
        lines = [" ".join(chance.choices(vocabulary, k=chance.randint(0, 14))) for _ in range(chance.randint(0, 12))]
        lines += chance.sample(common, k=chance.randint(0, 3)) * chance.choice([1, 1, 6, 20])
        chance.shuffle(lines)
        end = chance.choice(["", "\n", "\r\n", "\x0b"])
        rows.append((i % 280, chance.choice(["\n", "\n", "\r\n"]).join(lines) + end, chance.choice(["a", "a", "b", None, ""])))
    rows += [rows[5]] * 30 + [(None, "w " * 70, "a"), (None, None, None), (7, "", "a"), (8, "\n\n \n", "b")]
    return rows + [(9, "one two three " * 40, "a"), (10, " ".join(f"u{i}" for i in range(40_000)) + "\n" * 99, "c")]


def test_rules_on_odd_rows(spark, monkeypatch):
    rows = odd_rows()
    df = spark.createDataFrame([(*row, "l", 1, 0) for row in rows], SCHEMA).repartition(3)
    columns = ["doc_id", *linerules.BASE, "n_removed", "base_failed", "kept"]
    order = lambda found: sorted(found, key=str)
    for limits in ((20, 1000), (5, 10), (0, 10**9)):
        want, texts = plain(rows, *limits)
        got = linerules.check_lines(df, max_documents=limits[0], one_in=limits[1])
        assert got.columns == columns
        assert order(map(tuple, got.collect())) == order(want)
    assert any(row[-1] for row in want) is False
    want, texts = plain(rows, 5, 10)
    assert texts and any(row[6] and row[8] for row in want)
    monkeypatch.setattr(linerules, "BROADCAST_LINES", 0)
    got = linerules.without_boilerplate(df, max_documents=5, one_in=10)
    assert got.columns == df.columns
    assert order((row.doc_id, row.text) for row in got.collect()) == order(texts)
    assert linerules.check_lines(df.limit(0)).collect() == []
    assert linerules.without_boilerplate(df.limit(0)).collect() == []


def test_a_line_of_a_third_of_all_documents(spark):
    """The hot line and host are counted and removed by many tasks."""
    chance = random.Random(1)
    body = lambda: "\n".join(" ".join("".join(chance.choices("abcdefgh", k=9)) for _ in range(10)) for _ in range(6))
    rows = [(i, body() + "\nSubscribe to our letter" * (i % 3 == 0), "hot" if i % 3 else "cold") for i in range(3000)]
    df = spark.createDataFrame([(*row, "l", 1, 0) for row in rows], SCHEMA)
    got = linerules.check_lines(df).collect()
    assert sum(r.n_removed for r in got) == 4 * 1000 and all(r.kept for r in got)


def test_clean_documents_stay(spark):
    documents = spark.read.parquet(f"{compare.testdata('sf0.01')}/documents.parquet")
    got = linerules.check_lines(documents).collect()
    assert sum(r.kept for r in got) >= 0.9 * sum(not r.base_failed for r in got)
