"""The language models of ``langid`` as tables, for corpora whose models outgrow a broadcast.

The same counts give the same probabilities, by one join for each order. Distinct words are
scored by joins of their sequences with the tables, and texts by a join with their words. What is
collected is a number for each language and order; no table passes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from hitledger.llm.tables import stored


@dataclass
class Tables:
    """Languages; log probabilities by order and gram, and log weights by order and context.

    Both are arrays with a number or null for each language. usual and excess are the limits.
    """

    languages: list[str]
    grams: DataFrame
    contexts: DataFrame
    base: np.ndarray
    usual: np.ndarray = field(init=False)
    excess: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.usual = np.zeros(len(self.languages))
        self.excess = np.full(len(self.languages), np.inf)


def _by_entry(rows: DataFrame, entry: str, value: str, count: int) -> DataFrame:
    """One row for each entry with an array of its values in all languages."""
    columns = [F.max(F.when(F.col("lang") == k, F.col(value))) for k in range(count)]
    return rows.groupBy("ord", entry).agg(F.array(*columns).alias(value))


def kneser_ney(counts: DataFrame) -> Tables:
    """Tables from the added-up counts of ``langid.counted``."""
    from hitledger.llm.langid import ORDER, UNSEEN_CHARACTER

    languages = sorted(row["lang"] for row in counts.select("lang").distinct().collect())
    place = F.array_position(F.array(*map(F.lit, languages)), F.col("lang")).cast("int") - 1
    longer = counts.groupBy("lang", (F.col("ord") - 1).alias("ord"), F.col("suffix").alias("gram")).agg(
        F.count("*").alias("continuations")
    )
    value = F.when(F.col("whole"), F.col("n")).otherwise(
        F.least("n", F.coalesce("continuations", F.lit(0).cast("long")))
    )
    valued = stored(
        counts.join(longer, ["lang", "ord", "gram"], "left").select(
            place.alias("lang"), "ord", "gram", "suffix",
            F.when(F.col("ord") > 1, F.col("context")).otherwise(F.lit(0).cast("long")).alias("context"),
            value.alias("value"),
        ),
        "values",
    )
    singles = valued.groupBy("lang", "ord").agg(
        F.count_if(F.col("value") == 1).alias("ones"), F.count_if(F.col("value") == 2).alias("twos")
    )
    # a row for each language and order
    ones, twos = F.col("ones"), F.col("twos")
    share = F.when(ones + twos > 0, F.least(F.lit(0.9), F.greatest(F.lit(0.1), ones / (ones + 2 * twos)))).otherwise(0.5)
    discounts = stored(singles.select("lang", "ord", share.alias("discount")), "discounts")
    sums = valued.groupBy("lang", "ord", "context").agg(
        F.sum("value").alias("total"), F.count_if(F.col("value") > 0).alias("kinds")
    )
    weight = F.when(F.col("total") > 0, F.col("discount") * F.col("kinds") / F.col("total")).otherwise(F.lit(1.0))
    contexts = stored(
        sums.join(F.broadcast(discounts), ["lang", "ord"]).withColumn("weight", weight), "contexts"
    )
    shares = valued.join(contexts, ["lang", "ord", "context"])
    own = F.greatest(F.col("value") - F.col("discount"), F.lit(0.0)) / F.greatest("total", F.lit(1))
    below, parts = None, []
    for order in range(1, ORDER + 1):
        here = shares.where(F.col("ord") == order)
        lower: Column = F.lit(UNSEEN_CHARACTER)
        if below is not None:
            shorter = below.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("lower"))
            here, lower = here.join(shorter, ["lang", "suffix"]), F.col("lower")
        below = stored(here.select("lang", "ord", "gram", (own + F.col("weight") * lower).alias("p")), "probabilities")
        parts.append(below)
    grams = reduce(DataFrame.unionByName, parts).withColumn("log_p", F.log("p"))
    weights = contexts.withColumn("log_weight", F.log("weight"))
    first = {row["lang"]: row["weight"] for row in contexts.where("ord = 1").collect()}
    base = np.log([first.get(k, 1.0) * UNSEEN_CHARACTER for k in range(len(languages))])
    return Tables(
        languages,
        stored(_by_entry(grams, "gram", "log_p", len(languages)), "grams"),
        stored(_by_entry(weights.where("ord > 1"), "context", "log_weight", len(languages)), "weights"),
        base,
    )


def _sequence_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every character of a word and every order that exists there, its gram and context."""
    from hitledger.llm.langid import ARRAY_WORDS, ORDER, sequences

    for batch in batches:
        for at in range(0, len(batch), ARRAY_WORDS):
            listed = batch.column(0).slice(at, ARRAY_WORDS)
            found = sequences(listed.to_pylist())
            parts = []
            for order in range(1, ORDER + 1):
                here = np.flatnonzero(found.position >= max(1, order - 1))
                parts.append((
                    found.word[here], found.position[here], np.full(len(here), order),
                    found.by_order[order][here], found.by_order[order - 1][here - 1],
                ))
            word, position, order, gram, context = (np.concatenate(column) for column in zip(*parts, strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    listed.take(pa.array(word)),
                    pa.array(position.astype(np.int32)),
                    pa.array(order.astype(np.int32)),
                    pa.array(gram.view(np.int64)),
                    pa.array(context.view(np.int64)),
                ],
                ["word", "position", "ord", "gram", "context"],
            )


def score_words(words: DataFrame, model: Tables) -> DataFrame:
    """word and sums: the log probability of every distinct word by language."""
    tried = words.distinct().mapInArrow(
        _sequence_rows, "word string, position int, ord int, gram long, context long"
    )
    found = tried.join(model.grams, ["ord", "gram"], "left").join(model.contexts, ["ord", "context"], "left")
    # a character has as many rows as there are orders
    steps = F.reverse(F.array_sort(F.collect_list(F.struct("ord", "log_p", "log_weight"))))
    each = found.groupBy("word", "position").agg(steps.alias("steps"))

    def of_language(k: int, base: float) -> Column:
        begin = F.struct(F.lit(0.0).alias("sum"), F.lit(False).alias("done"))

        def step(state: Column, row: Column) -> Column:
            p, weight = F.get(row["log_p"], F.lit(k)), F.get(row["log_weight"], F.lit(k))
            more = F.when(state["done"], F.lit(0.0)).otherwise(F.coalesce(p, weight, F.lit(0.0)))
            return F.struct(
                (state["sum"] + more).alias("sum"), (state["done"] | p.isNotNull()).alias("done")
            )

        end = F.aggregate("steps", begin, step)
        return end["sum"] + F.when(end["done"], 0.0).otherwise(F.lit(base))

    scored = each.select("word", *[of_language(k, float(b)).alias(f"s{k}") for k, b in enumerate(model.base)])
    sums = [F.sum(f"s{k}").alias(f"s{k}") for k in range(len(model.languages))]
    return scored.groupBy("word").agg(*sums)


def _text_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from hitledger.llm.langid import words_of

    for batch in batches:
        for row, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            found, counts = np.unique(np.array(words_of(value.as_py()), dtype=object), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row] * len(found), pa.int64()), pa.array(found.tolist(), pa.string()), pa.array(counts, pa.int64())],
                ["row", "word", "times"],
            )


def score_rows(rows: DataFrame, model: Tables, text: str, passed: list[str]) -> DataFrame:
    """As ``langid.score_rows``."""
    from hitledger.llm.langid import ADDED, SCORE_CHARACTERS, UNDETERMINED

    names = [f"c{i}" for i in range(len(passed))]
    whole = rows.select(
        F.monotonically_increasing_id().alias("row"), F.col(text).cast("string").alias("text"),
        *[F.col(c).alias(n) for c, n in zip(passed, names, strict=True)],
    )
    numbered = stored(whole, "texts")
    held = stored(
        numbered.select("row", "text").mapInArrow(_text_words, "row long, word string, times long"), "words"
    )
    scores = stored(score_words(held.select("word"), model), "word-scores")
    count = len(model.languages)
    sums = [F.sum(F.col("times") * F.col(f"s{k}")).alias(f"s{k}") for k in range(count)]
    # adaptive execution divides the texts' side where one word is very common
    size = F.sum(F.col("times") * (F.length("word") + 1)).alias("n")
    of_text = held.join(scores, "word").groupBy("row").agg(*sums, size)
    joined = numbered.drop("text").join(of_text, "row", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
    each = joined.withColumn("each", F.array(*[-F.col(f"s{k}") / F.col("n") for k in range(count)]))
    lowest, power = F.array_min("each"), F.least("n", F.lit(SCORE_CHARACTERS))
    best = F.get(F.array(*map(F.lit, model.languages)), F.array_position("each", F.col("lowest")).cast("int") - 1)
    others = F.aggregate(
        "each", F.lit(0.0), lambda total, x: total + F.exp(-(x - F.col("lowest")) * F.col("power"))
    )
    letters = F.col("n") > 0
    made = each.withColumns({"lowest": lowest, "power": power}).select(
        *[F.col(n).alias(c) for n, c in zip(names, passed, strict=True)],
        F.when(letters, best).otherwise(UNDETERMINED).alias("lang_pred"),
        F.when(letters, 1 / others).otherwise(0.0).alias("score"),
        F.when(letters, F.col("lowest")).otherwise(F.lit(float("nan"))).alias("cross_entropy"),
        F.col("n").alias("n_letters"),
    )
    return made.select(*passed, *ADDED)
