"""Language identification by interpolated Kneser-Ney character models, one per language.

A word between two boundary marks is a sequence of characters, each predicted from up to four
before it in the word. Counts come from all training texts and are added up by Spark. Lower
orders count in how many different places a sequence follows (its continuations), and every
order gives up an absolute discount to the next lower one. The models of all languages share
sorted arrays of sequence hashes, searched by bisection, with a column of log probabilities
for each language. The language with the lowest cross-entropy per character wins; texts whose
cross-entropy is far above that of their language's training texts are rejected.

A sequence is known by its whole hash of 64 bits, and the entries grow with the corpus. Up to
MOST_ENTRIES of them the arrays are made on the driver and broadcast; beyond, ``langjoin`` makes
the same model as tables, by joins, and scores distinct words by joins with them.

Edge cases: a very long text is scored part by part, whole; a text that is null or has no
letter gets ``und``, score 0 and is rejected; with no training rows every text does; rows whose
text or language is null train nothing; equal cross-entropies go to the language that sorts
first; equal rows get equal results; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from hitledger.llm import langjoin
from hitledger.llm.tables import stored
from hitledger.llm.words import mix, slices

UNDETERMINED = "und"
ORDER = 5
#: Entries of all orders and languages that the driver takes and broadcasts at most, some 60
#: bytes each for the driver and 12 and 4 for each language for a worker.
MOST_ENTRIES = 2_000_000
#: Chance of a character that training never saw, before discounts.
UNSEEN_CHARACTER = 1e-4
#: Characters after which a score counts as certain as it gets.
SCORE_CHARACTERS = 40
#: The rejection limit is a multiple of the excess that few of the training texts pass.
CALIBRATION_QUANTILE = 0.999
CALIBRATION_FACTOR = 2.0
#: Nats per character above the usual that a text with fewer letters than that is not rejected
#: within, so that it is not for a few odd words. Longer ones go by the calibrated limit alone.
CALIBRATION_GAP = 1.5
GAP_CHARACTERS = 200
#: Longer texts get the limit of texts of this length.
CALIBRATION_CHARACTERS = 400
#: Steps to a nat that cross-entropies are counted in for the limits, so that a language has a
#: bounded number of them however many its texts.
CALIBRATION_STEPS = 2000
#: Distinct words of one language a counting task holds before it hands on counts, and scored
#: words a worker keeps.
HELD_WORDS = 60_000
CACHED_WORDS = 150_000
#: Words whose characters are worked on as arrays at once.
ARRAY_WORDS = 20_000
#: Words that are scored at once.
PART_WORDS = 100_000

START, END = "\x02", "\x03"
find_words: Callable[[str], list[str]] = re.compile(r"[^\W\d_]+").findall


def words_of(text: str | None) -> list[str]:
    """Runs of letters in lower case."""
    found = find_words(text.lower()) if text else []
    if found and not "".join(found).isalpha():  # fractions and the like pass for word characters
        letters = "".join([c if c.isalpha() else " " for c in " ".join(found)])
        found = letters.split()
    return found


@dataclass
class Sequences:
    """Hashes of the sequences that end at each character of some words, by order.

    by_order[n][p] is the hash of order n at character p. position is the place of p in its
    word, 0 at the start mark, so that orders up to position + 1 exist.
    """

    by_order: list[np.ndarray]
    position: np.ndarray
    word: np.ndarray


def sequences(words: list[str]) -> Sequences:
    codes = np.frombuffer(
        "".join([f"{START}{word}{END}" for word in words]).encode("utf-32-le", "surrogatepass"),
        dtype=np.uint32,
    ).astype(np.uint64)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 2
    starts = np.cumsum(lengths) - lengths
    word = np.repeat(np.arange(len(words)), lengths)
    position = np.arange(len(codes)) - starts[word]
    by_order = [np.zeros(len(codes), np.uint64), mix(codes + np.uint64(1))]
    for order in range(2, ORDER + 1):
        before = np.zeros_like(codes)
        before[order - 1 :] = codes[: len(codes) - order + 1]
        by_order.append(mix(by_order[-1] * np.uint64(0x9E3779B97F4A7C15) + before))
    return Sequences(by_order, position, word)


def _entry(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)


COUNTS = "lang string, ord int, gram long, suffix long, context long, n long, whole boolean"


def _count_rows(lang: str, counts: Counter[str]) -> pa.RecordBatch:
    words = list(counts)
    found = sequences(words)
    weights = np.fromiter(counts.values(), dtype=np.int64, count=len(words))[found.word]
    parts: list[list[np.ndarray]] = []
    for order in range(1, ORDER + 1):
        at = np.flatnonzero(found.position >= max(1, order - 1))
        gram = _entry(found.by_order[order][at])
        unique, first, where = np.unique(gram, return_index=True, return_inverse=True)
        n = np.bincount(where, weights=weights[at], minlength=len(unique))
        at = at[first]
        # the start mark has nothing before it, so its sequences count as they are
        whole = (found.position[at] == order - 1) | (order == ORDER)
        parts.append(
            [
                np.full(len(unique), order, np.int32),
                unique,
                _entry(found.by_order[order - 1][at]),
                _entry(found.by_order[order - 1][at - 1]),
                n.astype(np.int64),
                whole,
            ]
        )
    columns = [np.concatenate(column) for column in zip(*parts, strict=True)]
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(columns[0])), *map(pa.array, columns)],
        ["lang", "ord", "gram", "suffix", "context", "n", "whole"],
    )


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, Counter[str]] = defaultdict(Counter)
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1), strict=True):
            name = lang.as_py()
            held[name].update(words_of(text.as_py()))
            if len(held[name]) >= HELD_WORDS:
                yield _count_rows(name, held.pop(name))
    for name, counts in held.items():
        if counts:
            yield _count_rows(name, counts)


@dataclass
class Model:
    """Languages, and by order the sorted entries with log probabilities and log weights.

    grams[n] and contexts[n] are sorted; log_p[n] and log_weight[n] have a row for each of
    their entries and a column for each language. limits hold the usual cross-entropy and the
    largest excess of each language, once calibrated.
    """

    languages: list[str]
    grams: list[np.ndarray]
    log_p: list[np.ndarray]
    contexts: list[np.ndarray]
    log_weight: list[np.ndarray]
    base: np.ndarray
    usual: np.ndarray
    excess: np.ndarray


def _at(entries: np.ndarray, sought: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row of each sought entry in sorted entries, and whether it is there."""
    if not len(entries):
        return np.zeros(len(sought), np.int64), np.zeros(len(sought), bool)
    rows = np.searchsorted(entries, sought)
    rows[rows == len(entries)] = 0
    return rows, entries[rows] == sought


def kneser_ney(counts: pa.Table) -> Model:
    """The models from added-up counts."""
    columns = {name: counts.column(name).to_numpy() for name in counts.column_names if name != "lang"}
    names = counts.column("lang").combine_chunks().dictionary_encode() if len(counts) else None
    if names is None:
        empty = np.empty((0, 0))
        blank = [np.empty(0, np.int64)] * (ORDER + 1)
        return Model([], blank, [empty] * (ORDER + 1), blank, [empty] * (ORDER + 1), *[np.empty(0)] * 3)
    listed = names.dictionary.to_pylist()
    languages = sorted(listed)
    lang = np.array([languages.index(name) for name in listed])[names.indices.to_numpy()]
    grams = [np.empty(0, np.int64)]
    log_p: list[np.ndarray] = [np.empty((0, 0))]
    contexts = [np.empty(0, np.int64)]
    log_weight: list[np.ndarray] = [np.empty((0, 0))]
    below = np.empty((0, len(languages)))
    base = np.zeros(len(languages))
    for order in range(1, ORDER + 1):
        here = columns["ord"] == order
        longer = columns["ord"] == order + 1
        entries, first = np.unique(columns["gram"][here], return_index=True)
        suffix = columns["suffix"][here][first]
        context = columns["context"][here][first] if order > 1 else np.zeros_like(suffix)
        held = np.unique(context)
        p = np.empty((len(entries), len(languages)))
        weight = np.ones((len(held), len(languages)))
        for k in range(len(languages)):
            mine = here & (lang == k)
            rows, _ = _at(entries, columns["gram"][mine])
            n = np.zeros(len(entries))
            n[rows] = columns["n"][mine]
            whole = np.zeros(len(entries), bool)
            whole[rows] = columns["whole"][mine]
            after, known = _at(entries, columns["suffix"][longer & (lang == k)])
            continuations = np.bincount(after[known], minlength=len(entries))
            value = np.where(whole, n, np.minimum(n, continuations))
            ones, twos = (value == 1).sum(), (value == 2).sum()
            discount = min(0.9, max(0.1, ones / (ones + 2 * twos))) if ones + twos else 0.5
            group, _ = _at(held, context)
            total = np.bincount(group, weights=value, minlength=len(held))
            kinds = np.bincount(group, weights=value > 0, minlength=len(held))
            seen = total > 0
            weight[seen, k] = discount * kinds[seen] / total[seen]
            if order == 1:
                base[k] = np.log(weight[0, k] * UNSEEN_CHARACTER)
                lower = np.full(len(entries), UNSEEN_CHARACTER)
            else:
                at, _ = _at(grams[-1], suffix)
                lower = below[at, k]
            own = np.maximum(value - discount, 0) / np.maximum(total[group], 1)
            p[:, k] = own + weight[group, k] * lower
        grams.append(entries)
        contexts.append(held)
        log_p.append(np.log(p).astype(np.float32))
        log_weight.append(np.log(weight).astype(np.float32))
        below = p
    unknown = np.full(len(languages), np.inf)
    return Model(languages, grams, log_p, contexts, log_weight, base, np.zeros(len(languages)), unknown)


def log_probabilities(model: Model, words: list[str]) -> np.ndarray:
    """Log probability of each word under each language."""
    found = sequences(words)
    at = np.flatnonzero(found.position > 0)
    total = np.zeros((len(at), len(model.languages)), np.float32)
    waiting = np.arange(len(at))
    for order in range(ORDER, 0, -1):
        enough = found.position[at[waiting]] >= order - 1
        tried = waiting[enough]
        place = at[tried]
        rows, there = _at(model.grams[order], _entry(found.by_order[order][place]))
        total[tried[there]] += model.log_p[order][rows[there]]
        missing = tried[~there]
        if order > 1:
            rows, known = _at(
                model.contexts[order], _entry(found.by_order[order - 1][at[missing] - 1])
            )
            total[missing[known]] += model.log_weight[order][rows[known]]
        else:
            total[missing] += model.base.astype(np.float32)
        waiting = np.concatenate((waiting[~enough], missing))
    by_word = np.zeros((len(words), len(model.languages)))
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    sums = np.concatenate((np.zeros((1, total.shape[1])), np.cumsum(total, axis=0, dtype=float)))
    by_word[:] = sums[ends] - sums[np.concatenate(([0], ends[:-1]))]
    return by_word


class WordScores:
    """Log probabilities of the words a worker met lately."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.rows: dict[str, int] = {}
        self.scores = np.empty((CACHED_WORDS, len(model.languages)))

    def of(self, words: list[str]) -> np.ndarray:
        """A row for each word; words may be at most CACHED_WORDS."""
        new = set(words).difference(self.rows)
        if len(self.rows) + len(new) > CACHED_WORDS:
            self.rows.clear()
            new = set(words)
        if new:
            listed = list(new)
            first = len(self.rows)
            for at in range(0, len(listed), ARRAY_WORDS):
                part = listed[at : at + ARRAY_WORDS]
                to = slice(first + at, first + at + len(part))
                self.scores[to] = log_probabilities(self.model, part)
            self.rows.update(zip(listed, range(first, first + len(listed)), strict=True))
        at = np.fromiter(map(self.rows.__getitem__, words), dtype=np.int64, count=len(words))
        return self.scores[at]

    def of_texts(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Log probability of each text's words by language, and their characters and ends."""
        sums = np.zeros((len(texts), len(self.model.languages)))
        sizes = np.fromiter((len(words) + sum(map(len, words)) for words in texts), np.int64)
        waiting: list[int] = []
        held = 0

        def flush() -> None:
            nonlocal waiting, held
            scores = self.of([word for i in waiting for word in texts[i]])
            edges = np.cumsum([0, *(len(texts[i]) for i in waiting)])
            running = np.concatenate((np.zeros((1, scores.shape[1])), np.cumsum(scores, axis=0)))
            sums[waiting] = running[edges[1:]] - running[edges[:-1]]
            waiting, held = [], 0

        for i, words in enumerate(texts):
            if len(words) > PART_WORDS:
                for a in range(0, len(words), PART_WORDS):
                    sums[i] += self.of(words[a : a + PART_WORDS]).sum(axis=0)
                continue
            if held + len(words) > PART_WORDS:
                flush()
            waiting.append(i)
            held += len(words)
        if waiting:
            flush()
        return sums, sizes


def _decide(model: Model, sums: np.ndarray, sizes: np.ndarray) -> dict[str, np.ndarray]:
    count = len(sizes)
    if not model.languages:
        return {
            "lang_pred": np.full(count, UNDETERMINED, object),
            "score": np.zeros(count),
            "cross_entropy": np.full(count, np.nan),
        }
    letters = sizes > 0
    each = -sums / np.maximum(sizes, 1)[:, None]
    best = each.argmin(axis=1)
    lowest = each[np.arange(count), best]
    power = np.minimum(sizes, SCORE_CHARACTERS)[:, None]
    score = 1 / np.exp(-(each - lowest[:, None]) * power).sum(axis=1)
    names = np.array(model.languages, object)
    return {
        "lang_pred": np.where(letters, names[best], UNDETERMINED),
        "score": np.where(letters, score, 0.0),
        "cross_entropy": np.where(letters, lowest, np.nan),
    }


def _of_batch(scores: WordScores, values: pa.Array) -> dict[str, np.ndarray]:
    """What ADDED names, for every text; few texts are held as words at once."""
    texts: list[list[str]] = []
    sums, sizes, held = [], [], 0

    def flush() -> None:
        nonlocal texts, held
        for out, part in zip((sums, sizes), scores.of_texts(texts), strict=True):
            out.append(part)
        texts, held = [], 0

    for value in values:
        texts.append(words_of(value.as_py()))
        held += len(texts[-1])
        if held >= PART_WORDS:
            flush()
    flush()
    n_letters = np.concatenate(sizes)
    return _decide(scores.model, np.concatenate(sums), n_letters) | {"n_letters": n_letters}


def _training(rows: DataFrame, known: Column, lang: str, text: str) -> DataFrame:
    return rows.where(known & F.col(lang).isNotNull() & F.col(text).isNotNull())


def counted(rows: DataFrame, known: Column, text: str = "text", lang: str = "lang") -> DataFrame:
    """Counts of the sequences in the training texts, by language and order, stored."""
    training = _training(rows, known, lang, text)
    counts = (
        training.select(F.col(lang).cast("string"), F.col(text).cast("string"))
        .mapInArrow(_counted, COUNTS)
        .groupBy("lang", "ord", "gram")
        .agg(
            F.sum("n").alias("n"),
            F.min("suffix").alias("suffix"),
            F.min("context").alias("context"),
            F.max("whole").alias("whole"),
        )
    )
    return stored(counts, "counts")


def models(rows: DataFrame, known: Column, text: str = "text", lang: str = "lang") -> Model | langjoin.Tables:
    """Models of all languages in the rows known to be labelled rightly, without limits.

    The driver receives at most MOST_ENTRIES entries; a larger model stays in tables.
    """
    counts = counted(rows, known, text, lang)
    if counts.count() <= MOST_ENTRIES:
        return kneser_ney(counts.toArrow())
    return langjoin.kneser_ney(counts)


def train(
    rows: DataFrame, known: Column, key: str = "doc_id", text: str = "text", lang: str = "lang"
) -> Model | langjoin.Tables:
    """The models with limits, which all training texts set.

    The driver receives two rows for each language with its limits.
    """
    model = models(rows, known, text, lang)
    if model.languages:
        scored = score_rows(_training(rows, known, lang, text), model, text, [])
        _calibrate(model, stored(scored, "calibration"))
    return model


def learn_and_identify(
    rows: DataFrame, known: Column, key: str = "doc_id", text: str = "text", lang: str = "lang",
    keep: list[str] | None = None,
) -> DataFrame:
    """``identify`` by what the known rows teach, with every text scored once.

    The limits come from the scores of the known rows. keep names columns that pass through.
    """
    model = models(rows, known, text, lang)
    passed = [key, *(name for name in keep or [] if name != key)]
    trains = known & F.col(lang).isNotNull() & F.col(text).isNotNull()
    marked = rows.select(*passed, *([] if text in passed else [text]), trains.alias("__trains"))
    scored = stored(score_rows(marked, model, text, [*passed, "__trains"]), "scores")
    if model.languages:
        _calibrate(model, scored.where("__trains"))
    return with_rejected(scored, model).drop("__trains")


def _quantiles(scored: DataFrame, value: Column, share: float) -> dict[str, float]:
    """A quantile of a value by language, to within a step."""
    step = F.round(value * CALIBRATION_STEPS).cast("long")
    rows = (
        scored.groupBy("lang_pred", step.alias("step"))
        .agg(F.count("*").alias("texts"))
        .groupBy("lang_pred")
        .agg(F.percentile("step", F.lit(share), F.col("texts")).alias("step"))
        .collect()
    )
    return {row["lang_pred"]: row["step"] / CALIBRATION_STEPS for row in rows}


def _calibrate(model: Model | langjoin.Tables, scored: DataFrame) -> None:
    """Set the limits from all training texts, by the language each is found to be in."""
    scored = scored.where("n_letters > 0")
    usual = _quantiles(scored, F.col("cross_entropy"), 0.5)
    if not usual:
        return
    at = scored.sparkSession.createDataFrame(list(usual.items()), "lang_pred string, usual double")
    root = F.sqrt(F.least(F.col("n_letters"), F.lit(CALIBRATION_CHARACTERS)))
    above = (F.col("cross_entropy") - F.col("usual")) * root
    excess = _quantiles(scored.join(F.broadcast(at), "lang_pred"), above, CALIBRATION_QUANTILE)
    for k, name in enumerate(model.languages):
        if name in usual:
            model.usual[k] = usual[name]
            model.excess[k] = CALIBRATION_FACTOR * excess[name]


def with_rejected(scored: DataFrame, model: Model | langjoin.Tables) -> DataFrame:
    """Scores with ``rejected``, by the limits of the model's languages."""
    n = F.col("n_letters")

    def of_language(values: np.ndarray) -> Column:
        chain = F.lit(None).cast("double")
        for name, value in zip(model.languages, values.tolist(), strict=True):
            chain = F.when(F.col("lang_pred") == name, F.lit(float(value))).otherwise(chain)
        return chain

    above = F.col("cross_entropy") - of_language(model.usual)
    excess = above * F.sqrt(F.least(n, F.lit(CALIBRATION_CHARACTERS)))
    tolerated = (n < GAP_CHARACTERS) & (above <= CALIBRATION_GAP)
    far = ~tolerated & (excess > of_language(model.excess))
    return scored.withColumn("rejected", (n == 0) | F.coalesce(far, F.lit(True)))


def score_rows(rows: DataFrame, model: Model | langjoin.Tables, text: str, passed: list[str]) -> DataFrame:
    """The passed columns, lang_pred, score, cross_entropy and n_letters of every row."""
    if isinstance(model, langjoin.Tables):
        return langjoin.score_rows(rows, model, text, passed)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordScores(shared.value)
        for batch in (part for batch in batches for part in slices(batch, 0)):
            made = _of_batch(words, batch.column(0))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], *(pa.array(made[name]) for name in ADDED)],
                [*names, *ADDED],
            )

    picked = rows.select(F.col(text).cast("string").alias("__text"), *[F.col(c) for c in passed])
    names = [f"c{i}" for i in range(len(passed))]
    kinds = [picked.schema[i + 1].dataType.simpleString() for i in range(len(passed))]
    schema = ", ".join([*map(" ".join, zip(names, kinds, strict=True)), *map(" ".join, ADDED.items())])
    out = picked.toDF("__text", *names).mapInArrow(predict, schema)
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, passed, strict=True)], *ADDED)


def identify(
    rows: DataFrame, model: Model | langjoin.Tables, key: str = "doc_id", text: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """Key, lang_pred, score, cross_entropy, n_letters and rejected of every row.

    keep names columns that pass through.
    """
    passed = [key, *(name for name in keep or [] if name not in (key, text))]
    return with_rejected(score_rows(rows, model, text, passed), model)


def accepted_rows(rows: DataFrame, known: Column, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows, whole, that are not rejected by what the known ones teach.

    Every text is scored once: rows go to the shared folder with their scores, the limits come
    from these, and what is within them is read back.
    """
    names = [f"__{i}" for i in range(len(rows.columns))]
    place = {name: names[i] for i, name in enumerate(rows.columns)}
    whole = rows.withColumn("__known", known).toDF(*names, "__known")
    model = models(whole, F.col("__known"), place[text], place[lang])
    scored = stored(score_rows(whole, model, place[text], [*names, "__known"]), "scores")
    if model.languages:
        _calibrate(model, _training(scored, F.col("__known"), place[lang], place[text]))
    kept = with_rejected(scored, model).where("NOT rejected")
    return kept.select(*[F.col(n).alias(c) for n, c in zip(names, rows.columns, strict=True)])


#: What scoring adds to a row.
ADDED = {
    "lang_pred": "string",
    "score": "double",
    "cross_entropy": "double",
    "n_letters": "long",
}
