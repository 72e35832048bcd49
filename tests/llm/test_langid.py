"""Language models against a plain Kneser-Ney, held-out accuracy, rejection and edge cases."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from hitledger.llm import langid
from hitledger.llm.registry import op4_langid
from tests import compare

WORDS = "the then there other mother them hat that heat eat tea ten net".split()


def plain_model(words: Counter):
    """Probability of a character after a context, by the textbook recursion."""
    grams = defaultdict(Counter)
    for word, n in words.items():
        text = langid.START + word + langid.END
        for order in range(1, langid.ORDER + 1):
            for i in range(max(1, order - 1), len(text)):
                grams[order][text[i - order + 1 : i + 1]] += n
    value = {}
    for order in range(1, langid.ORDER + 1):
        before = Counter(g[1:] for g in grams[order + 1])
        value[order] = {
            g: n if order == langid.ORDER or g[0] == langid.START else before[g]
            for g, n in grams[order].items()
        }

    def discount(order):
        counts = list(value[order].values())
        ones, twos = counts.count(1), counts.count(2)
        return min(0.9, max(0.1, ones / (ones + 2 * twos))) if ones + twos else 0.5

    def p(context, char):
        order = len(context) + 1
        lower = p(context[1:], char) if context else langid.UNSEEN_CHARACTER
        after = {g: n for g, n in value[order].items() if g[:-1] == context}
        total = sum(after.values())
        if not total:
            return lower
        d = discount(order)
        own = max(after.get(context + char, 0) - d, 0) / total
        return own + d * sum(n > 0 for n in after.values()) / total * lower

    def log_p(word):
        text = langid.START + word + langid.END
        return sum(
            math.log(p(text[max(0, i - langid.ORDER + 1) : i], text[i])) for i in range(1, len(text))
        )

    return log_p


def test_probabilities_are_kneser_ney():
    counts = Counter({word: i + 1 for i, word in enumerate(WORDS)})
    table = pa.Table.from_batches([langid._count_rows("en", counts)])
    model = langid.kneser_ney(table)
    asked = [*WORDS, "zebra", "hath", "ñ", "a"]
    plain = plain_model(counts)
    np.testing.assert_allclose(
        langid.log_probabilities(model, asked)[:, 0], [plain(word) for word in asked], rtol=1e-4
    )


def test_held_out_accuracy(spark):
    sf = compare.testdata("sf0.01")
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = [r for r in op4_langid(spark, sf).collect() if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in rows) / len(rows) > 0.98
    assert sum(r["rejected"] for r in rows) / len(rows) < 0.01
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_edge_cases(spark):
    schema = "doc_id long, text string, lang string, score string, rejected int"
    english = " ".join(WORDS * 5)
    rows = [(i, english, "en", "x", 1) for i in range(30)]
    rows += [(100 + i, "der die das und nicht ein eine sein " * 4, "de", "x", 1) for i in range(30)]
    rows += [(200, None, "en", "x", 1), (201, "12 34 !", None, "x", 1), (202, "", "de", "x", 1)]
    rows += [(206, "½ ² 7 Ⅷ", "en", "x", 1)]
    rows += [(203, "the other mother", None, "x", 1)] * 2
    rows += [(204, "жизнь прекрасна и удивительна каждый день", None, "x", 1)]
    rows += [(205, "that heat " * 120_000, None, "x", 1), (None, "nicht sein", None, "x", 1)]
    df = spark.createDataFrame(rows, schema)
    model = langid.train(df, F.lit(True))
    got = {r["doc_id"]: r for r in langid.identify(df, model).collect()}
    assert langid.identify(df, model).count() == len(rows)
    for key in (200, 201, 202, 206):
        assert (got[key]["lang_pred"], got[key]["score"], got[key]["rejected"]) == ("und", 0.0, True)
    assert got[203]["lang_pred"] == got[205]["lang_pred"] == "en" and not got[203]["rejected"]
    assert got[204]["rejected"] and got[None]["lang_pred"] == "de"
    untrained = langid.train(df, F.lit(False))
    assert {r["lang_pred"] for r in langid.identify(df, untrained).collect()} == {"und"}
    assert langid.identify(df.limit(0), model).collect() == []


def test_limits_come_from_all_texts(spark):
    """A language with a few texts among very many gets its limits, and they are quantiles."""
    chance = "element_at(shuffle(split('{}', ' '), {}), 1)"
    common, rare = " ".join(WORDS), "der die das und nicht ein eine sein"
    words = [F.expr(chance.format(common, i)) for i in range(6)]
    english = spark.range(60_000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *words).alias("text"), F.lit("en").alias("lang"))
    # keys that a sample of 4000 by their hash would leave out
    left_out = spark.range(60_000, 61_000).where("pmod(xxhash64(id), 1000000) > 500000").limit(12)
    german = left_out.select(F.col("id").alias("doc_id"), F.lit(rare).alias("text"), F.lit("de").alias("lang"))
    df = english.unionByName(german)
    model = langid.train(df, F.lit(True))
    assert np.isfinite(model.excess).all() and (model.usual > 0).all()
    found = langid.identify(df, model).where("lang_pred = 'en'").toPandas()
    usual = np.median(found["cross_entropy"])
    excess = (found["cross_entropy"] - usual) * np.sqrt(np.minimum(found["n_letters"], langid.CALIBRATION_CHARACTERS))
    at = model.languages.index("en")
    np.testing.assert_allclose(model.usual[at], usual, atol=2e-3)
    limit = langid.CALIBRATION_FACTOR * np.quantile(excess, langid.CALIBRATION_QUANTILE)
    np.testing.assert_allclose(model.excess[at], limit, atol=5e-2)


def test_a_model_in_tables_gives_the_same(spark, monkeypatch):
    """Beyond the size of a broadcast, model and scores come from joins."""
    documents = spark.read.parquet(f"{compare.testdata('sf0.001')}/documents.parquet")
    odd = [(None, "ñandú zzz", "fr", "s", 1), (900, None, "de", "s", 1), (901, "12 !", None, "s", 1), (902, "", "en", "s", 1)]
    documents = documents.unionByName(spark.createDataFrame(odd * 2, documents.schema))
    known = F.col("lang").isNotNull() & (F.coalesce("doc_id", F.lit(1)) % 4 != 2)
    by_row = lambda df: sorted(map(tuple, df.select("doc_id", "lang_pred", "rejected", "n_letters", "score", F.nanvl("cross_entropy", F.lit(-1.0))).collect()), key=str)
    want = by_row(langid.learn_and_identify(documents, known))
    model = langid.train(documents, known)
    assert by_row(langid.identify(documents, model)) == want
    kept = langid.accepted_rows(documents, known)
    assert kept.columns == documents.columns
    monkeypatch.setattr(langid, "MOST_ENTRIES", 0)
    got = by_row(langid.learn_and_identify(documents, known))
    assert len(got) == len(want) == documents.count()
    for mine, plain in zip(got, want, strict=True):
        assert mine[:4] == plain[:4]
        np.testing.assert_allclose(mine[4:], plain[4:], rtol=1e-4)
    order = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert order(langid.accepted_rows(documents, known)) == order(kept)
    assert 0 < kept.count() < documents.count()
    assert langid.learn_and_identify(documents.limit(0), known).collect() == []
    assert {r.lang_pred for r in langid.learn_and_identify(documents, F.lit(False)).collect()} == {"und"}


def test_predictions_on_whole_texts_equal_the_plain_model(spark):
    """lang_pred and cross-entropy of whole texts by the textbook recursion."""
    rows = spark.read.parquet(f"{compare.testdata('sf0.001')}/documents.parquet").where("length(text) < 1500").collect()
    counts = defaultdict(Counter)
    for row in rows:
        if row.lang and row.doc_id % 2:
            counts[row.lang].update(langid.words_of(row.text))
    plain = {name: plain_model(words) for name, words in counts.items()}
    df = spark.createDataFrame(rows)
    got = {r.doc_id: r for r in langid.learn_and_identify(df, F.col("doc_id") % 2 == 1).collect()}
    asked = [row for row in rows if row.doc_id % 2 == 0 and langid.words_of(row.text)][:6]
    for row in asked:
        words = langid.words_of(row.text)
        size = sum(map(len, words)) + len(words)
        each = {name: -sum(log_p(word) for word in words) / size for name, log_p in plain.items()}
        assert got[row.doc_id].lang_pred == min(each, key=each.get)
        np.testing.assert_allclose(got[row.doc_id].cross_entropy, min(each.values()), rtol=1e-3)
    assert len(asked) == 6
