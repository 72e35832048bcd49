"""Template findings against a plain version, re-parameterised questions, edge cases."""

from __future__ import annotations

import re

from hitledger.llm import decontaminate
from tests import compare

DOC = "doc_id long, text string, item_id int, slots string, window int"
ITEM = "item_id long, text string, key string"
QUESTION = (
    "Last week Anna Smith bought 12 apples and walked 3.5 km to the market where Anna sold "
    "every apple to Bob for 40 cents, so how much did she earn in the end?"
)


def pairs(df) -> set:
    return {(r["doc_id"], r["item_id"]) for r in df.collect()}


def plain_tokens(text: str) -> list:
    """(template token, value) of a text; one regular expression at a time."""
    out, behind = [], 0
    for m in re.finditer(rb"[A-Za-z0-9\x80-\xff]+", text.encode()):
        raw, word = m.group(), m.group().lower().decode("utf-8", "replace")
        begins = behind == 0 or re.search(rb"[.!?:;\n\r]", text.encode()[behind : m.start()])
        kind = ""
        if re.match(rb"\d", raw) or word in decontaminate.NUMBER_WORDS:
            kind = "1"
        elif out and out[-1][0] == "1" and word in decontaminate.UNITS:
            kind = "2"
        elif not begins and re.match(rb"[A-Z](?![A-Z])|\xc3[\x80-\x9e]", raw):
            kind = "3"
        if kind and out and out[-1][0] == kind:
            out[-1] = (kind, out[-1][1], m.end())
        else:
            out.append((kind or word, m.start() if kind else None, m.end()))
        behind = m.end()
    low = text.encode().lower()
    return [(t, low[a:b] if a is not None else None) for t, a, b in out]


def plain_findings(docs, items) -> set:
    sought = {}
    for key, text in items:
        tokens = plain_tokens(text)
        size = min(decontaminate.WINDOW, len(tokens))
        if size >= decontaminate.SHORTEST:
            for i in range(len(tokens) - size + 1):
                part = tokens[i : i + size]
                if sum(v is None for _, v in part) >= decontaminate.LITERAL_SHARE * size:
                    sought.setdefault(tuple(t for t, _ in part), []).append((key, part))
    found = set()
    for key, text in docs:
        tokens = plain_tokens(text or "")
        for size in {len(t) for t in sought}:
            for i in range(len(tokens) - size + 1):
                part = tokens[i : i + size]
                for item, other in sought.get(tuple(t for t, _ in part), []):
                    slots = [((t, a), (t, b)) for (t, a), (_, b) in zip(part, other) if a is not None]
                    if len(set(slots)) == len({a for a, _ in slots}) == len({b for _, b in slots}):
                        found.add((key, item))
    return found


def test_documents_agree_with_plain_version(spark):
    sf = compare.testdata("sf0.01")
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf}/benchmark.parquet")
    docs = [(r["doc_id"], r["text"]) for r in documents.collect()]
    items = [(r["item_id"], r["text"]) for r in benchmark.collect()]
    found = pairs(decontaminate.findings(documents, benchmark))
    assert found == plain_findings(docs, items)
    whole = {(d, i) for d, text in docs for i, item in items if item in text}
    assert whole and whole <= found


def test_reparameterised_questions_are_found(spark):
    again = QUESTION.replace("Anna Smith", "Clara").replace("Anna", "Clara").replace("Bob", "David")
    docs = [
        (1, "Intro. " + QUESTION + " Outro."),
        (2, "Intro. " + again.replace("12", "7").replace("3.5 km", "9 miles").replace("40", "15")),
        (3, QUESTION.upper()),
        (4, QUESTION.replace("Bob", "Anna")),
        (5, "Nothing of the kind is here, only other words about other things in a row."),
    ]
    df = spark.createDataFrame([(*row, 1, "s", 1) for row in docs], DOC)
    items = spark.createDataFrame([(9, QUESTION, "k")], ITEM)
    found = {r["doc_id"]: r for r in decontaminate.findings(df, items).collect()}
    assert {1, 2} <= set(found) and 5 not in found
    assert found[1]["exact"]
    # windows with one name for two people are inconsistent, so fewer remain
    assert found[4]["n_windows"] < found[2]["n_windows"]


def test_edge_cases(spark):
    items = spark.createDataFrame(
        [(1, QUESTION, "k"), (2, None, "k"), (None, QUESTION, "k"), (3, "too short", "k"),
         (4, "six words only are in here", "k"), (5, "1 2 3 4 5 6 7 8 9", "k")], ITEM)
    rows = [(1, None), (2, ""), (3, "x " * 300_000 + QUESTION), (4, QUESTION), (4, QUESTION),
            (None, QUESTION), (None, "clean"), (6, "so Six words only are in here now"), (7, "1 2 3 " * 9)]
    df = spark.createDataFrame([(*row, 1, "s", 1) for row in rows], DOC)
    found = decontaminate.findings(df, items)
    assert pairs(found) == {(3, 1), (4, 1), (None, 1), (6, 4)}
    left = decontaminate.without_findings(df, found)
    assert left.columns == df.columns
    kept = [(r["doc_id"], r["text"]) for r in left.collect()]
    assert len(kept) == 4 and (None, "clean") in kept and (None, QUESTION) not in kept
    assert pairs(decontaminate.findings(df.limit(0), items)) == set()
    assert pairs(decontaminate.findings(df, items.limit(0))) == set()


def test_windows_hang_on_nothing_before_them(spark):
    items = [
        (1, "What is the boiling point of water"), (2, "Anna Smith bought 12 apples and then Anna sold them all"),
        (3, "Days of the week are how many in 12 months"),
    ]
    docs, want = [], set()
    before = ["", "Question 5) ", "- ", "(", "so, ", "then Bob, ", "of 7 "]
    for i, (item, text) in enumerate((item, text) for item, text in items for _ in before):
        docs.append((i, before[i % len(before)] + text + ", no doubt"))
        want.add((i, item))
    docs += [(90, "Question 5) Clara Jones bought 7 apples and then Clara sold them all"), (91, "no Days of the year are how many")]
    want.add((90, 2))
    df = spark.createDataFrame([(*row, 1, "s", 1) for row in docs], DOC)
    found = decontaminate.findings(df, spark.createDataFrame([(*row, "k") for row in items], ITEM))
    assert pairs(found) == want


def test_items_of_few_literal_words_are_found_word_by_word(spark):
    items = [
        (1, "Who wrote Hamlet?"), (2, "Solve x + 3 = 7"), (3, "12 13 14 15 16 17"), (4, "3 + 4"), (None, "a b c d e"),
        (5, "Paris, London, Rome, Berlin, Madrid, Vienna"), (6, "The Old Man And The Sea By Ernest Hemingway"),
    ]
    docs = [(i, f"as he asked, {text.lower()} and so on") for i, text in items[:3] + items[5:]]
    docs += [(20, "who wrote Macbeth"), (21, "12 13 14 15 16 18"), (22, "solve x + 4 = 7"), (23, "3 + 4")]
    df = spark.createDataFrame([(*row, 1, "s", 1) for row in docs], DOC)
    benchmark = spark.createDataFrame([(*row, "k") for row in items], ITEM)
    found = decontaminate.findings(df, benchmark)
    assert pairs(found) == {(i, i) for i in (1, 2, 3, 5, 6)}
    assert decontaminate.not_sought(benchmark) == 2
