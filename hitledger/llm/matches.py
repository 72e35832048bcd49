"""Positions of pattern matches in whole texts, with built-in column expressions alone."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, functions as F

from hitledger.operators.parsing import compute_once

#: Characters before and behind a match that come along.
TAIL = 40
#: Matches whose positions are summed up together.
SUM_BLOCK = 256

PAIRS = "array<struct<gap:int,size:int,match:string,tail:string,head:string>>"
SPANS = "array<struct<start:int,end:int,match:string,tail:string,head:string>>"


def _parts(text: Column, pattern: str, needed: Column) -> Column:
    """Matches and the texts between them, if the text can hold a match at all."""
    found = F.struct(
        F.split(text, pattern, -1).alias("gaps"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("matches"),
    )
    kind = "struct<gaps:array<string>,matches:array<string>>"
    none = F.struct(F.array().alias("gaps"), F.array().alias("matches"))
    return F.when(needed, found.cast(kind)).otherwise(none.cast(kind))


def _pairs(parts: Column) -> Column:
    gaps, matches = parts["gaps"], parts["matches"]
    count = F.size(matches)
    zipped = F.arrays_zip(
        F.slice(gaps, F.lit(1), count).alias("before"),
        F.slice(gaps, F.lit(2), count).alias("behind"),
        matches.alias("match"),
    )
    return F.transform(
        zipped,
        lambda x: F.struct(
            F.length(x["before"]).alias("gap"),
            F.length(x["match"]).alias("size"),
            x["match"].alias("match"),
            F.right(x["before"], F.lit(TAIL)).alias("tail"),
            F.left(x["behind"], F.lit(TAIL)).alias("head"),
        ),
    ).cast(PAIRS)


def _block(pairs: Column, block: Column) -> Column:
    return F.slice(pairs, block * SUM_BLOCK + 1, F.lit(SUM_BLOCK))


def _blocks(pairs: Column) -> Column:
    last = F.greatest(F.size(pairs) - 1, F.lit(0))
    return F.sequence(F.lit(0), F.floor(last / SUM_BLOCK).cast("int"))


def _length(pairs: Column, block: Column) -> Column:
    part = _block(pairs, block)
    return F.aggregate(part, F.lit(0), lambda total, pair: total + pair["gap"] + pair["size"])


def _spans(pairs: Column, before: Column) -> Column:
    """Positions of matches, block by block, so that work stays near linear in their number."""

    def place(block: Column) -> Column:
        start = F.struct(
            F.element_at(before, block + 1).alias("at"), F.array().cast(SPANS).alias("out")
        )

        def add(done: Column, pair: Column) -> Column:
            first = done["at"] + pair["gap"]
            last = first + pair["size"]
            span = F.struct(
                first.alias("start"),
                last.alias("end"),
                *[pair[name].alias(name) for name in ("match", "tail", "head")],
            )
            return F.struct(last.alias("at"), F.concat(done["out"], F.array(span)).alias("out"))

        return F.aggregate(_block(pairs, block), start, add, lambda done: done["out"])

    return F.flatten(F.transform(_blocks(pairs), place))


def located(
    rows: DataFrame,
    text: Column,
    keep: Sequence[Column],
    patterns: Mapping[str, str],
    needs: Mapping[str, str],
) -> DataFrame:
    """keep, and found, a struct with each pattern's matches: start, end, match, tail and head.

    Positions are code points, ends exclusive; tail and head are what stands before and behind
    a match, up to the neighbouring match. needs holds cheap patterns without which a text has
    no match. A pattern runs once per text to match and once to split; what is in between is
    generated, so that Spark evaluates none of it twice.
    """
    df = rows.select(*keep, text.alias("_text"))
    content = F.col("_text")
    parts = [_parts(content, p, content.rlike(needs[name])).alias(name) for name, p in patterns.items()]
    df = compute_once(df, "_parts", F.struct(*parts)).drop("_text")
    pairs = [_pairs(F.col("_parts")[name]).alias(name) for name in patterns]
    df = compute_once(df, "_pairs", F.struct(*pairs)).drop("_parts")
    sums = [
        F.transform(_blocks(F.col("_pairs")[name]), partial(_length, F.col("_pairs")[name])).alias(name)
        for name in patterns
    ]
    df = compute_once(df, "_sums", F.struct(*sums))
    before = [
        F.aggregate(
            F.col("_sums")[name],
            F.array(F.lit(0)),
            lambda done, x: F.concat(done, F.array(F.element_at(done, -1) + x)),
        ).alias(name)
        for name in patterns
    ]
    df = compute_once(df, "_before", F.struct(*before))
    spans = [_spans(F.col("_pairs")[n], F.col("_before")[n]).alias(n) for n in patterns]
    names = [name for name in df.columns if not name.startswith("_")]
    return df.select(*names, F.struct(*spans).alias("found"))
