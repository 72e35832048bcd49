"""Section token counts against a plain interval join, and edge cases."""

from __future__ import annotations

from fractions import Fraction

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from hitledger.llm import tokencounts
from tests import compare

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SCHEMA = "doc_id long, text string, key string, section string, n_tokens int"


@pytest.fixture(scope="module")
def reference():
    made = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    made.encode_special_tokens = True
    return made


def plain(reference, text: str, rule: str, separator: str) -> list:
    """Counts by comparing every token with every section."""
    sections, at = [], 0
    for part in text.split(separator)[:-1]:
        sections.append((at, at + len(part) + len(separator)))
        at = sections[-1][1]
    if at < len(text) or not text:
        sections.append((at, len(text)))
    counts = [Fraction(0)] * len(sections)
    for a, b in reference.encode(text, add_special_tokens=False).offsets:
        for k, (low, high) in enumerate(sections):
            if rule == "start":
                counts[k] += low <= a < high
            elif rule == "end":
                counts[k] += low < b <= high
            else:
                counts[k] += Fraction(max(0, min(b, high) - max(a, low)), b - a)
    return [(k, low, high - low, float(n)) for k, ((low, high), n) in enumerate(zip(sections, counts))]


@pytest.mark.parametrize(("rule", "separator"), [("start", "\n"), ("end", ". "), ("share", "th")])
def test_counts_agree_with_every_pair(spark, reference, rule, separator):
    documents = spark.read.parquet(f"{compare.testdata('sf0.001')}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in documents.collect()}
    got: dict = {key: [] for key in rows}
    counted = tokencounts.count_section_tokens(documents, RANKS, public_tokenizers.PATTERN, rule, separator)
    for r in counted.orderBy("doc_id", "section").collect():
        got[r["doc_id"]].append((r["section"], r["first_char"], r["n_chars"], r["n_tokens"]))
    for key, text in rows.items():
        want = plain(reference, text, rule, separator)
        assert [row[:3] for row in got[key]] == [row[:3] for row in want]
        assert [row[3] for row in got[key]] == pytest.approx([row[3] for row in want])


def test_edge_cases(spark):
    rows = [
        (1, None), (2, ""), (3, "\n"), (4, "a\n\nb"), (5, "漢字😀\n漢\n"), (5, "漢字😀\n漢\n"),
        (6, "word " * 200_000 + "\nend"), (7, "<|endoftext|>\nx"), (None, "x"),
    ]
    df = spark.createDataFrame([(*row, "k", "s", 1) for row in rows], SCHEMA)
    for rule in tokencounts.RULES:
        counted = tokencounts.count_section_tokens(df, RANKS, public_tokenizers.PATTERN, rule)
        got = counted.collect()
        tokenizer = tokencounts.tokenizer_of(RANKS, public_tokenizers.PATTERN)
        total = sum(len(tokenizer.encoding.encode_ordinary(text or "")) for _, text in rows)
        assert sum(r["n_tokens"] for r in got) == pytest.approx(total)
        by = {(r["doc_id"], r["section"]): r["n_tokens"] for r in got}
        assert by[1, 0] == by[2, 0] == 0
        assert max(section for key, section in by if key == 4) == 2
        assert sum(r["doc_id"] == 5 for r in got) == 4
    empty = tokencounts.count_section_tokens(df.limit(0), RANKS, public_tokenizers.PATTERN)
    assert empty.collect() == []
    with pytest.raises(ValueError):
        tokencounts.count_section_tokens(df, RANKS, public_tokenizers.PATTERN, "middle")


@pytest.mark.parametrize(("rule", "separator"), [("start", "\n"), ("end", " "), ("share", "")])
def test_fields_of_a_row(spark, reference, rule, separator):
    """Fields count what their characters have in the document as it is encoded whole."""
    documents = spark.read.parquet(f"{compare.testdata('sf0.001')}/documents.parquet")
    odd = [(None, "a", None, "", 1), (900, None, None, None, 2), (901, "", "x", "y z", None), (901, "", "x", "y z", None)]
    rows = documents.unionByName(spark.createDataFrame(odd, documents.schema))
    fields = ["lang", "text", "n_chars", "source"]
    counted = tokencounts.count_field_tokens(rows, fields, RANKS, public_tokenizers.PATTERN, rule, separator)
    got: dict = {}
    for r in counted.collect():
        got.setdefault(r["doc_id"], []).append((r["field"], r["first_char"], r["n_chars"], r["n_tokens"]))
    for row in rows.distinct().collect():
        parts = ["" if row[name] is None else str(row[name]) for name in fields]
        edges, text = [], ""
        for i, part in enumerate(parts):
            begin = len(text)
            text += part + (separator if i < len(parts) - 1 else "")
            edges.append((begin, len(text)))
        counts = [Fraction(0)] * len(fields)
        for a, b in reference.encode(text, add_special_tokens=False).offsets:
            for k, (low, high) in enumerate(edges):
                if rule == "start":
                    counts[k] += low <= a < high
                elif rule == "end":
                    counts[k] += low < b <= high
                else:
                    counts[k] += Fraction(max(0, min(b, high) - max(a, low)), b - a)
        want = [(name, low, high - low) for name, (low, high) in zip(fields, edges)]
        mine = got[row["doc_id"]][: len(fields)]
        assert sorted(r[:3] for r in mine) == sorted(want)
        by_field = {r[0]: r[3] for r in mine}
        assert [by_field[name] for name in fields] == pytest.approx([float(n) for n in counts])
    assert len(got[901]) == 2 * len(fields)
    for bad in ([], ["text", "text"]):
        with pytest.raises(ValueError):
            tokencounts.count_field_tokens(rows, bad, RANKS, public_tokenizers.PATTERN)
    nothing = tokencounts.count_field_tokens(rows.limit(0), fields, RANKS, public_tokenizers.PATTERN)
    assert nothing.collect() == []
