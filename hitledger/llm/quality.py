"""Text quality by Bradley-Terry ranking of labelled texts.

A text's strength is a weighted sum of features of its whole text. From pairs of labelled
texts of which one is preferred, the weights are those that maximise the likelihood that the
preferred one wins, a logistic loss on the difference of the features. The cut between good
and bad is the strength at the quantile that the share of bad labels gives.

All labelled texts are learned from. They are dealt into parts of bounded size in which pairs
are formed; a step adds up the parts' slopes, so the driver sees one small matrix a step.
Sums are of whole numbers, so they don't depend on the order of the parts.

Edge cases: a very long text is worked on alone and whole, some 50 bytes for each of its bytes;
equal scores are equal verdicts; null text counts as empty, and empty text has features of its
own (all zero) and so a score; rows of labels without key or label are not used; without both a
good and a bad label every score is 0.5; repeated rows get equal scores and are all kept; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from hitledger.llm.tables import discard, stored
from hitledger.llm.words import SPACES, chunks, slices, split_words

FEATURES = (
    "log_bytes", "upper", "exclamations", "bars", "symbols", "digits", "stops", "word_bytes",
    "repeats", "distinct", "commonest", "lines", "beyond_ascii",
)
#: Labelled texts of the commoner label in a part, and those of the rarer one that a part should
#: have; if these are too few for that, each of them goes to several parts.
PART_ROWS, PART_RARER = 8192, 64
#: Partners of every labelled text of the rarer label.
PARTNERS = 8
#: Pull of the weights towards zero, in pairs.
RIDGE = 1.0
NEWTON_STEPS = 25
#: Standard deviations from the centre beyond which a feature counts no further.
REACH = 4.0
#: Score at the cut.
CUT_SCORE = 0.3
#: Sums are of whole multiples of 1 / FIXED, strengths are ranked in those of 1 / GRAIN.
FIXED, GRAIN = 2.0**50, 2.0**40

_UPPER, _LOWER, _BANG, _BAR, _SYMBOL, _DIGIT, _STOP, _LINE, _HIGH, _SPACE = range(10)
KINDS = 10


def _kinds() -> np.ndarray:
    table = np.full(256, _SYMBOL)
    for i in range(256):
        char = chr(i)
        if i >= 128:
            table[i] = _HIGH
        elif char.isupper():
            table[i] = _UPPER
        elif char.islower():
            table[i] = _LOWER
        elif char.isdigit():
            table[i] = _DIGIT
        elif char in ".,;:'\"?-":
            table[i] = _STOP
        elif char == "\n":
            table[i] = _LINE
        elif char.isspace():
            table[i] = _SPACE
    table[ord("!")], table[ord("|")] = _BANG, _BAR
    return table


_KIND = _kinds()


def features_of(texts: list[str | None]) -> np.ndarray:
    """A row of FEATURES for every text."""
    encoded = [(text or "").encode("utf-8", "surrogatepass") for text in texts]
    out = np.zeros((len(texts), len(FEATURES)))
    for run in chunks([len(text) for text in encoded]):
        group = [encoded[i] for i in run]
        words = split_words(group, SPACES)
        buffer = np.frombuffer(b"".join(group), dtype=np.uint8)
        sizes = np.fromiter(map(len, group), dtype=np.int64, count=len(group))
        owner = np.repeat(np.arange(len(group)), sizes)
        kinds = np.bincount(owner * KINDS + _KIND[buffer], minlength=len(group) * KINDS)
        kinds = kinds.reshape(len(group), KINDS)
        counts = np.diff(words.offsets)
        rows = out[run.start : run.stop]
        per_word = np.maximum(counts, 1)
        letters = np.maximum(kinds[:, _UPPER] + kinds[:, _LOWER], 1)
        rows[:, 0] = np.log1p(sizes)
        rows[:, 1] = kinds[:, _UPPER] / letters
        for column, kind in ((2, _BANG), (3, _BAR), (4, _SYMBOL), (5, _DIGIT), (6, _STOP)):
            rows[:, column] = kinds[:, kind] / per_word
        rows[:, 7] = (sizes - kinds[:, _SPACE] - kinds[:, _LINE]) / per_word
        same = np.zeros(len(words.hashes) + 1)
        same[1:-1] = words.hashes[1:] == words.hashes[:-1]
        running = np.concatenate(([0.0], np.cumsum(same)))
        for i in range(len(group)):
            first, last = words.offsets[i], words.offsets[i + 1]
            if last > first:
                found = np.sort(words.hashes[first:last])
                edges = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1], [True])))
                runs = np.diff(edges)
                rows[i, 8] = (running[last] - running[first + 1]) / (last - first)
                rows[i, 9] = len(runs) / (last - first)
                rows[i, 10] = runs.max() / (last - first)
        rows[:, 11] = kinds[:, _LINE] / per_word
        rows[:, 12] = kinds[:, _HIGH] / np.maximum(sizes, 1)
    return out


def text_features(rows: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and FEATURES of every row's whole text."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for batch in batches for part in slices(batch, 1)):
            values = features_of(batch.column(1).to_pylist())
            columns = [pa.array(np.ascontiguousarray(column)) for column in values.T]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["key", *FEATURES])

    picked = rows.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = picked.schema["key"].dataType.simpleString()
    schema = f"key {kind}, " + ", ".join(f"{name} double" for name in FEATURES)
    return picked.mapInArrow(describe, schema)


@dataclass
class Ranking:
    """Centre, scale and weight of every feature, and the strength at the cut."""

    centre: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    cut: float
    learned: bool

    def strength(self, values: np.ndarray) -> np.ndarray:
        return self.scaled(values) @ self.weight

    def scaled(self, values: np.ndarray) -> np.ndarray:
        return np.clip((values - self.centre) / self.scale, -REACH, REACH)

    def score(self) -> Column:
        """Score from 0 to 1 as an expression over the columns FEATURES."""
        if not self.learned:
            return F.lit(0.5)
        start = float(np.log(CUT_SCORE / (1 - CUT_SCORE)) - self.cut)
        return 1 / (1 + F.exp(-self.strength_column(start)))

    def strength_column(self, start: float) -> Column:
        """Strength above start as an expression over the columns FEATURES."""
        total: Column = F.lit(start)
        for name, centre, scale, weight in zip(
            FEATURES, self.centre, self.scale, self.weight, strict=True
        ):
            scaled = (F.col(name) - float(centre)) / float(scale)
            held = F.greatest(F.lit(-REACH), F.least(F.lit(REACH), scaled))
            total = total + held * float(weight)
        return total


def differences(scaled: np.ndarray, good: np.ndarray, part: int = 0) -> np.ndarray:
    """Features of good rows minus those of bad ones, a row for each preference pair of a part."""
    better, worse = np.flatnonzero(good), np.flatnonzero(~good)
    if not len(better) or not len(worse):
        return scaled[:0]
    pairs = max(len(better), len(worse), PARTNERS * min(len(better), len(worse)))
    chance = np.random.default_rng(part)
    wins = np.concatenate([chance.permutation(better) for _ in range(pairs // len(better) + 1)])
    loses = np.concatenate([chance.permutation(worse) for _ in range(pairs // len(worse) + 1)])
    return scaled[wins[:pairs]] - scaled[loses[:pairs]]


def slopes(difference: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Gradient of the likelihood of pairs as first row, its curvature as the others."""
    p = 1 / (1 + np.exp(-np.clip(difference @ weight, -30, 30)))
    curvature = (difference.T * (p * (1 - p))) @ difference
    return np.vstack((difference.T @ (1 - p), curvature))


def fitted(total: Callable[[np.ndarray], np.ndarray], count: int) -> np.ndarray:
    """Weights by Newton steps, of which total gives the slopes of all pairs."""
    weight = np.zeros(count)
    for _ in range(NEWTON_STEPS):
        found = total(weight)
        gradient = found[0] - RIDGE * weight
        step = np.linalg.solve(found[1:] + RIDGE * np.eye(count), gradient)
        weight += step
        if np.abs(step).max() < 1e-8:
            break
    return weight


def bradley_terry(values: np.ndarray, good: np.ndarray) -> Ranking:
    """Weights from preference pairs of good over bad rows, of which there are few."""
    count = values.shape[1]
    scale = values.std(axis=0) if len(values) else np.ones(count)
    scale[scale == 0] = 1
    centre = values.mean(axis=0) if len(values) else np.zeros(count)
    if good.all() or not good.any():
        return Ranking(centre, scale, np.zeros(count), 0.0, learned=False)
    scaled = np.clip((values - centre) / scale, -REACH, REACH)
    difference = differences(scaled, good)
    weight = fitted(lambda weight: slopes(difference, weight), count)
    strength = np.sort(scaled @ weight)
    below = int((~good).sum())  # the quantile of the bad labels' share
    cut = (strength[below - 1] + strength[below]) / 2
    return Ranking(centre, scale, weight, float(cut), learned=True)


def _fixed_sum(value: Column) -> Column:
    """Sum of a double in multiples of 1 / FIXED, the same in whatever order."""
    return F.sum((value * FIXED).cast("decimal(38,0)"))


def _parts(labelled: DataFrame, ranking: Ranking, good: int, bad: int) -> DataFrame:
    """part, number of rows, scaled features and labels of every part, as bytes."""
    parts = ceil(max(good, bad) / PART_ROWS)
    rarer = min(good, bad)
    copies = min(parts, max(1, ceil(PART_RARER * parts / rarer)))
    order = F.xxhash64("key")
    times = F.when(F.col("good") == F.lit(good < bad), copies).otherwise(1)
    dealt = labelled.select("*", order.alias("order"), F.explode(F.sequence(F.lit(0), times - 1)).alias("copy"))
    part = F.pmod(F.pmod("order", F.lit(parts)) + F.col("copy"), F.lit(parts)).alias("part")

    def pack(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([(name, "ascending") for name in ("order", "key", "good", *FEATURES)])
        values = np.stack([rows.column(name).to_numpy() for name in FEATURES], axis=1)
        marks = rows.column("good").to_numpy().astype(bool)
        return pa.table(
            {
                "part": rows.column("part").slice(0, 1),
                "scaled": pa.array([ranking.scaled(values).tobytes()], pa.binary()),
                "good": pa.array([marks.tobytes()], pa.binary()),
            }
        )

    columns = [part, "order", "key", F.col("good").cast("int").alias("good"), *FEATURES]
    packed = dealt.select(*columns).groupBy("part").applyInArrow(pack, "part long, scaled binary, good binary")
    return stored(packed, "parts")


def _slopes_of(parts: DataFrame, weight: np.ndarray) -> np.ndarray:
    """Slopes of the pairs of all parts."""

    def of_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                part, scaled, good = (batch.column(i)[row].as_py() for i in range(3))
                values = np.frombuffer(scaled).reshape(-1, len(FEATURES))
                pairs = differences(values, np.frombuffer(good, dtype=bool), part)
                found = slopes(pairs, weight).ravel()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(found))), pa.array(found)], ["place", "value"]
                )

    summed = parts.mapInArrow(of_parts, "place long, value double").groupBy("place")
    total = np.zeros((len(FEATURES) + 1, len(FEATURES)))
    for place, value in summed.agg(_fixed_sum(F.col("value"))).collect():
        total.flat[place] = float(value) / FIXED
    return total


def _at_rank(values: DataFrame, rank: int) -> int:
    """The value of a column of longs that so many others precede, from counts of leading bits."""
    for shift in (48, 32, 16, 0):
        head = F.shiftright("value", shift)
        # at most 65,536 rows, as the bits before are the same in all
        for found, count in values.groupBy(head.alias("head")).count().orderBy("head").collect():
            if rank < count:
                break
            rank -= count
        values = values.where(head == found)
    return found


def _cut(labelled: DataFrame, ranking: Ranking, bad: int) -> float:
    """Strength at the quantile of the bad labels' share, over all labelled texts."""
    strength = F.round(ranking.strength_column(0.0) * GRAIN).cast("long")
    values = stored(labelled.select(strength.alias("value")), "strengths")
    low = _at_rank(values, bad - 1)
    upto, above = values.agg(
        F.count_if(F.col("value") <= low), F.min(F.when(F.col("value") > low, F.col("value")))
    ).first()
    discard(values)
    high = low if upto > bad else above
    # a grain lower, so that rounding leaves texts right at the cut on its good side
    return ((low + high) / 2 - 1) / GRAIN


def learn(
    features: DataFrame, labels: DataFrame, known: Column, key: str = "doc_id", label: str = "quality"
) -> Ranking:
    """Ranking from all labels that may be learned from; known is a condition on their key."""
    usable = labels.where(known & F.col(key).isNotNull() & F.col(label).isNotNull()).select(
        F.col(key).alias("key"), (F.col(label) > 0).alias("good")
    )
    labelled = stored(features.join(usable.distinct(), "key").select("key", "good", *FEATURES), "labelled")
    good, bad, *sums = labelled.agg(
        F.count_if("good"), F.count_if(~F.col("good")), *[_fixed_sum(F.col(name)) for name in FEATURES]
    ).first()
    rows, count = good + bad, len(FEATURES)
    if not good or not bad:
        discard(labelled)
        return Ranking(np.zeros(count), np.ones(count), np.zeros(count), 0.0, learned=False)
    centre = np.array([float(value) / FIXED / rows for value in sums])
    off = [F.col(name) - float(middle) for name, middle in zip(FEATURES, centre, strict=True)]
    squares = labelled.agg(*[_fixed_sum(distance * distance) for distance in off]).first()
    scale = np.sqrt([float(value) / FIXED / rows for value in squares])
    scale[scale == 0] = 1
    ranking = Ranking(centre, scale, np.zeros(count), 0.0, learned=True)
    parts = _parts(labelled, ranking, good, bad)
    ranking.weight = fitted(lambda weight: _slopes_of(parts, weight), count)
    ranking.cut = _cut(labelled, ranking, bad)
    discard(labelled, parts)
    return ranking


def score_quality(
    rows: DataFrame,
    labels: DataFrame,
    known: Column,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> DataFrame:
    """Key, score and predicted (1 from CUT_SCORE on) of every row."""
    features = stored(text_features(rows, key, text), "features")
    ranking = learn(features, labels, known, key, label)
    return features.select(F.col("key").alias(key), ranking.score().alias("score")).withColumn(
        "predicted", (F.col("score") >= CUT_SCORE).cast("int")
    )
