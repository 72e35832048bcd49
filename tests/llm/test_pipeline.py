"""The corpus pipeline against plain versions of its stages, and odd rows."""

from __future__ import annotations

import re

import public_tokenizers
import sentencepiece

import corpus_pipeline
from hitledger.llm.registry import queries
from tests import compare
from tests.llm import plain
from tests.llm.test_decontaminate import plain_findings
from tests.llm.test_pii import PLAIN, passes

SF = compare.testdata("sf0.001")


def masked(text: str) -> str:
    spans = sorted(
        (m.start(), kind, m.end())
        for kind, name in enumerate(PLAIN) for m in re.finditer(PLAIN[name], text) if passes(name, m.group())
    )
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"[{list(PLAIN)[kind]}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def test_run_agrees_with_plain_stages(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = {r["doc_id"]: r for r in documents}
    groups = plain.near_duplicates([(k, r["text"]) for k, r in docs.items()], 5, "0.8")
    kept = {k: docs[k]["text"] for k, (_, _, stays) in groups.items() if stays}
    leaked = {k for k, _ in plain_findings(kept.items(), items)}
    library = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path(corpus_pipeline.PIECE_MODEL)
    )
    want = {k: library.encode(masked(text)) for k, text in kept.items() if k not in leaked}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"]: r["ids"] for r in got} == want
    assert len(got) == len(want) < len(kept) < len(docs)
    for r in got:
        assert r["lossless"] and r["n_tokens"] == len(r["ids"])
        assert (r["lang"], r["source"]) == (docs[r["doc_id"]]["lang"], docs[r["doc_id"]]["source"])


def test_stages_on_odd_rows(spark):
    english = "the other mother then had that heat and there was a net of ten teas for them "
    rows = [(i, english + f"number word{i} " * 3, "en", "s", 1, i) for i in range(12)]
    rows += [(100, english * 9, "en", "s", 1, 0)] * 3 + [(100, english * 9 + "end", "en", "s", 1, 0)]
    rows += [(None, english + "mail a@b.co", None, None, None, 0)] * 2
    rows += [(101, None, None, None, None, 0), (102, "", None, None, 0, 0), (103, "12 34", "en", "s", 5, 0)]
    rows += [(104, "мы знаем что это другой язык совсем не похожий " * 5, None, "s", 1, 0)]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, found long"
    )
    stages = dict(corpus_pipeline.STAGES)
    known = stages["language_id"](spark, docs, SF)
    assert known.columns == docs.columns
    ids = [r["doc_id"] for r in known.collect()]
    assert not {101, 102, 103, 104} & set(ids) and len(ids) == 18
    single = stages["near_duplicates"](spark, known, SF)
    assert single.columns == docs.columns
    ids = [r["doc_id"] for r in single.collect()]
    assert ids.count(100) == 1 and ids.count(None) == 2
    clean = stages["benchmark"](spark, single, SF)
    assert sorted(map(repr, (r["doc_id"] for r in clean.collect()))) == sorted(map(repr, ids))
    private = stages["personal_data"](spark, clean, SF)
    assert private.columns == docs.columns
    texts = [(r["text"], r["n_chars"]) for r in private.collect() if r["doc_id"] is None]
    assert texts == [(english + "mail [email]", len(english) + 12)] * 2
    tokens = stages["token_ids"](spark, private, SF).collect()
    assert len(tokens) == len(ids) and all(r["lossless"] for r in tokens)
    nothing = docs.limit(0)
    for stage in stages.values():
        nothing = stage(spark, nothing, SF)
        assert nothing.collect() == []


def test_it_is_registered():
    import __spark_entry__ as entry

    named = entry.queries()
    assert {"pipeline", *queries()} <= set(named)
    assert [name.split("_")[0] for name in queries()] == [f"op{n}" for n in range(1, 14)]
