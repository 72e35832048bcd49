"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides.

Patterns give candidates. Labelers of three sorts vote for or against each or abstain: rules
on the match itself, gazetteers, and the words before it. Expectation-maximisation over the
counts of vote patterns estimates how reliable each labeler is and how likely each pattern is
personal data; with these as soft labels a logistic classifier on features of the span is
trained, and it decides on the candidates of the wide patterns. What the base patterns match
and their checks accept is always kept.

Only built-in column expressions touch the rows; the driver sees a table of vote and feature
patterns, whose size is bounded by the number of their combinations.

Positions are code points from 0, ends exclusive. Edge cases: a very long text is searched whole; of overlapping spans of one kind the leftmost
stays; null text counts as empty and has no spans; kinds may overlap each other, matches of one
kind don't; without candidates nothing is learned and no span is added; equal rows get equal
results; a null key is carried along; an empty table gives an empty result; columns other than
key and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, Row, functions as F

from hitledger.llm.matches import located
from hitledger.llm.tables import stored, text_or_empty
from hitledger.operators.parsing import compute_once

# Base patterns. Possessive repeats and the looks behind change no match: a repeat's class
# never holds what follows it, and a start within a run is only tried behind a match. They
# keep work linear in the text, however long its runs are.
_NAME = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:(?<!{_NAME})|\G){_NAME}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# Wide patterns, for candidates that only the classifier can accept.
WIDE = {
    "email_spelled": rf"(?<!{_NAME}){_NAME}{{1,64}}+ ?(?:\[at\]|\(at\)) ?[A-Za-z0-9-]{{1,63}}+"
    r"(?: ?(?:\.|\[dot\]|\(dot\)) ?[A-Za-z0-9-]{1,63}+){1,8}",
    "phone_local": r"(?<![0-9+.-])(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9.-])",
    "national_id": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
}
KINDS = [*BASE, *WIDE]
#: A text that matches none of these holds no match of the kind.
NEEDS = {
    "email": "@", "phone": r"\+[0-9]", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][ -]?[0-9]",
    "email_spelled": r"[\[(]at[\])]", "phone_local": r"[0-9][ .-][0-9]{3}|\) ?[0-9]{3}",
    "national_id": r"[0-9]-[0-9]{2}-[0-9]", "iban": r"[A-Z]{2}[0-9]{2}[A-Z0-9 ]{12}",
}

_FOR_WORDS = "mail contact call phone tel fax mobile cell card visa iban account ssn address reach".split()
_AGAINST_WORDS = "version release isbn page section chapter figure invoice part model serial".split()
_RESERVED = r"^(?:0|10|127|255)\.|^192\.168\.|^169\.254\.|@(?:localhost|invalid|test)\b"
_KNOWN = r"(?i)@(?:[a-z0-9-]+\.)*(?:mail|gmail|yahoo|hotmail|outlook|icloud)|^\+(?:1|33|34|44|49)\b"

LABELERS = ("rule", "length", "gazetteer", "context", "repeats")
EM_STEPS = 100
NEWTON_STEPS = 20
RIDGE = 1.0
#: Digits from which a number is a candidate to learn from.
CARD_CANDIDATE = 8
#: Probability from which a candidate of a wide pattern becomes a span.
ACCEPT = 0.5


def candidates(rows: DataFrame, text: Column, keep: Sequence[Column]) -> DataFrame:
    """keep, and the matches of every kind of pattern."""
    return located(rows, text, keep, BASE | WIDE, NEEDS)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    size = F.length(digits)

    def add(total: Column, place: Column) -> Column:
        value = F.substring(digits, place, F.lit(1)).cast("int")
        twice = value * 2
        doubled = F.when(twice > 9, twice - 9).otherwise(twice)
        return total + F.when((size - place) % 2 == 1, doubled).otherwise(value)

    return F.aggregate(F.sequence(F.lit(1), size), F.lit(0), add) % 10 == 0


def accepted(kind: str, match: Column) -> Column:
    """Whether a match of a base pattern passes the check of its kind."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        # at most 255, with or without leading zeros
        return ~match.rlike(r"(?:^|\.)0*+(?:25[6-9]|2[6-9][0-9]|[3-9][0-9]{2}|[0-9]{4})")
    if kind == "card":
        digits = F.translate(match, " -", "")
        # the checksum is only taken of numbers of the right length
        return F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(F.lit(False))
    return F.length(_digits(match)).between(9, 15)


def votes(kind: Column, match: Column, tail: Column) -> dict[str, Column]:
    """1, -1 or 0 of every labeler."""
    digits = F.length(_digits(match))
    good_base = F.lit(False)
    for name in BASE:
        good_base = good_base | ((kind == name) & accepted(name, match))
    shape = F.when(kind.isin(*BASE), F.when(good_base, 1).otherwise(-1)).when(
        kind == "national_id", F.when(match.rlike("^(?:000|666|9)|-00-|-0000$"), -1).otherwise(1)
    ).when(kind == "email_spelled", F.when(match.rlike("[A-Za-z]{2,}$"), 1).otherwise(-1)).when(kind == "phone_local", F.when(match.rlike(r"^\(|[^0-9]1?[2-9][0-9]{2}[^0-9]"), 1).otherwise(0))
    words = F.lower(tail)
    for_words = "|".join(_FOR_WORDS)
    against_words = "|".join(_AGAINST_WORDS)
    against = words.rlike(rf"\b(?:{against_words})\b[^a-z]*$") | words.rlike(r"[$€£#]\s*$")
    mail = kind.isin("email", "email_spelled")
    return {
        "rule": F.coalesce(shape, F.lit(0)),
        "length": F.when(mail, 0).when(digits < 8, -1).when(digits >= 9, 1).otherwise(0),
        "gazetteer": F.when(match.rlike(_RESERVED), -1).when(match.rlike(_KNOWN), 1).otherwise(0),
        "context": F.when(against, -1).when(words.rlike(rf"(?:{for_words})[^.]*$"), 1).otherwise(0),
        "repeats": F.when(_digits(match).rlike(r"^(.)\1{5,}$"), -1).otherwise(0),
    }


def features(kind: Column, match: Column, tail: Column) -> list[Column]:
    """Numbers a span is classified by; each takes few values."""
    found = votes(kind, match, tail)
    digits = F.length(_digits(match))
    return [
        *[(kind == name).cast("int") for name in KINDS],
        F.least(digits, F.lit(20)),
        F.least(F.length(F.regexp_replace(match, "[A-Za-z0-9]", "")), F.lit(6)),
        *[found[name] for name in ("context", "repeats", "gazetteer")],
        match.rlike(r"^\(|^\+").cast("int"),
        tail.rlike(r"[A-Za-z0-9]$").cast("int"),
        F.lit(1),
    ]


def reliabilities(patterns: dict[tuple[int, ...], int]) -> tuple[dict[tuple[int, ...], float], list[float]]:
    """Probability of personal data for each vote pattern, and how often each labeler is right.

    Each labeler that votes is right with a probability of its own, and independently of the
    others given the truth. Votes start out as right four times in five.
    """
    count = len(next(iter(patterns)))
    right, share = [0.8] * count, 0.5
    posterior: dict[tuple[int, ...], float] = {}
    total = sum(patterns.values())
    for _ in range(EM_STEPS):
        for pattern in patterns:
            yes, no = math.log(share), math.log(1 - share)
            for vote, p in zip(pattern, right, strict=True):
                if vote:
                    yes += math.log(p if vote > 0 else 1 - p)
                    no += math.log(1 - p if vote > 0 else p)
            posterior[pattern] = 1 / (1 + math.exp(min(500.0, max(-500.0, no - yes))))
        before = [share, *right]
        # one more vote of either sort keeps every estimate inside (0, 1)
        share = (1 + sum(n * posterior[p] for p, n in patterns.items())) / (total + 2)
        for k in range(count):
            hits, cast = 4.0, 5.0
            for pattern, n in patterns.items():
                if pattern[k]:
                    cast += n
                    hits += n * (posterior[pattern] if pattern[k] > 0 else 1 - posterior[pattern])
            # a labeler that is mostly wrong would turn the meaning of the classes around
            right[k] = min(0.999, max(0.5, hits / cast))
        if max(abs(a - b) for a, b in zip(before, [share, *right], strict=True)) < 1e-9:
            break
    return posterior, right


def logistic(rows: list[tuple[Sequence[int], float, int]], size: int) -> list[float]:
    """Weights from (features, soft label, count), by Newton's method with a ridge."""
    import numpy as np

    x = np.array([row[0] for row in rows], dtype=float).reshape(len(rows), size)
    y = np.array([row[1] for row in rows])
    n = np.array([row[2] for row in rows], dtype=float)
    weight = np.zeros(size)
    for _ in range(NEWTON_STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ weight, -30, 30)))
        gradient = x.T @ (n * (y - p)) - RIDGE * weight
        curvature = (x.T * (n * p * (1 - p))) @ x + RIDGE * np.eye(size)
        step = np.linalg.solve(curvature, gradient)
        weight += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return [float(w) for w in weight]


@dataclass
class SpanModel:
    """Weights of the span classifier, and the estimated reliability of each labeler."""

    weights: list[float]
    reliability: dict[str, float]

    def accepts_span(self, kind: str, span: Column) -> Column:
        return self.accepts(F.lit(kind), span["match"], span["tail"])

    def accepts(self, kind: Column, match: Column, tail: Column) -> Column:
        if not self.weights:
            return F.lit(False)
        total: Column = F.lit(0.0)
        for weight, value in zip(self.weights, features(kind, match, tail), strict=True):
            total = total + value * weight
        return total >= math.log(ACCEPT / (1 - ACCEPT))


def _passes(kind: str, span: Column) -> Column:
    return accepted(kind, span["match"])


def _candidate(kind: str, span: Column) -> Column:
    return F.struct(
        F.lit(kind).alias("kind"), span["match"].alias("match"), span["tail"].alias("tail")
    )


def train(found: DataFrame) -> SpanModel:
    """Model from the candidates of all rows of ``candidates``."""
    each = found.select(
        F.explode(
            F.concat(*[F.transform(F.col("found")[kind], partial(_candidate, kind)) for kind in KINDS])
        ).alias("c")
    ).select("c.*")
    kind, match, tail = F.col("kind"), F.col("match"), F.col("tail")
    # runs of a few digits are everywhere and would only teach that they are no cards
    each = each.where((kind != "card") | (F.length(_digits(match)) >= CARD_CANDIDATE))
    voted = votes(kind, match, tail)
    table: list[Row] = (
        each.select(
            F.array(*[voted[name] for name in LABELERS]).alias("votes"),
            F.array(*features(kind, match, tail)).alias("features"),
        )
        .groupBy("votes", "features")
        .agg(F.count("*").alias("n"))
        .orderBy("votes", "features")
        .collect()  # combinations of small numbers, however many candidates there are
    )
    if not table:
        return SpanModel([], {})
    patterns: dict[tuple[int, ...], int] = {}
    for row in table:
        patterns[tuple(row["votes"])] = patterns.get(tuple(row["votes"]), 0) + row["n"]
    posterior, right = reliabilities(patterns)
    rows = [(row["features"], posterior[tuple(row["votes"])], row["n"]) for row in table]
    return SpanModel(logistic(rows, len(table[0]["features"])), dict(zip(LABELERS, right, strict=True)))


def _listed(spans: Column) -> Column:
    """kind:start:end of sorted spans, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(
        ",",
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")),
        ),
    )


def _placed(spans: Column, kind: str) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), s["end"].alias("end")),
    )


def decided(found: DataFrame, model: SpanModel) -> DataFrame:
    """``candidates`` rows with arrays base and added of (start, kind, end) instead of matches."""
    kept = {kind: F.filter(F.col("found")[kind], partial(_passes, kind)) for kind in BASE}
    names = [name for name in found.columns if name != "found"]
    base = compute_once(
        found, "base", F.concat(*[_placed(spans, kind) for kind, spans in kept.items()])
    )
    more = F.concat(
        *[_placed(F.filter(F.col("found")[kind], partial(model.accepts_span, kind)), kind) for kind in WIDE]
    )
    both = compute_once(base, "more", more)
    apart = F.filter(
        "more",
        lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
    )
    return both.select(*names, "base", F.when(F.size("more") > 0, apart).otherwise(F.col("more")).alias("added"))


def find_personal_data(rows: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, counts of the base kinds, base_sha256, spans and n_added of every row's whole text."""
    found = stored(candidates(rows, text_or_empty(F.col(text)), [F.col(key).alias("key")]), "candidates")
    spans = decided(found, train(found))

    def count(kind: str) -> Column:
        number = KINDS.index(kind)
        return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("long")

    return spans.select(
        F.col("key").alias(key),
        *[count(kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(_listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _listed(F.concat("base", "added")).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )


def mask_personal_data(rows: DataFrame, text: str = "text") -> DataFrame:
    """The rows with every span of personal data replaced by its kind in brackets.

    Spans that overlap become one, named after the first. Null text stays null.
    """
    held = [F.col(name).alias(name) for name in rows.columns]
    content = text_or_empty(F.col(text))
    found = stored(candidates(rows, content, [F.struct(*held).alias("row")]), "candidates")
    spans = decided(found, train(found))
    ordered = compute_once(spans, "marks", F.array_sort(F.concat("base", "added")))
    names = F.array(*map(F.lit, KINDS))
    body = F.col("row")[text]

    def cut(done: Column, s: Column) -> Column:
        fresh = s["start"] >= done["at"]
        between = F.substring(body, done["at"] + 1, s["start"] - done["at"])
        label = F.concat(F.lit("["), F.element_at(names, s["kind"] + 1), F.lit("]"))
        return F.struct(
            F.greatest(done["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(done["out"], F.array(between, label))).otherwise(done["out"]).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    rest = lambda done: F.concat(
        F.array_join(done["out"], ""), F.substring(body, done["at"] + 1, F.length(body))
    )
    masked = F.when(F.size("marks") > 0, F.aggregate("marks", start, cut, rest)).otherwise(body)
    return ordered.select(
        *[(masked if name == text else F.col("row")[name]).alias(name) for name in rows.columns]
    )
