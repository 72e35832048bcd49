"""Rendezvous hashing of stable record keys over weighted shards.

Every record draws one number per shard from its key and the shard's name and goes to the
shard of the best draw. Adding a shard adds one draw, so a record either stays or goes to the
new shard. Only built-in column expressions are used.

Edge cases: a very long text is hashed whole where it is read; equal draws go to the smaller
shard; a null key counts as the text ``null``; null text has no bytes and size 1; equal rows go
to the same shard and get slots of their own; an empty table gives an empty result; columns
other than key and text are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from hitledger.llm.tables import text_or_empty

LAW = "key"
#: Parts of a shard whose rows are numbered together. A part is sorted in one task, so more
#: parts suit more rows; the table of parts has shards x parts rows.
SLOT_PARTS = 1024
#: Draws are whole numbers below 2**52, exact as doubles.
DRAW_DIGITS = 13


def _draw(key: Column, shard: int) -> Column:
    digest = F.md5(F.concat(key, F.lit(f":{shard}")).cast("binary"))
    return F.conv(F.substring(digest, 1, DRAW_DIGITS), 16, 10).cast("long")


def rendezvous_shard(key: Column, weights: Sequence[float]) -> Column:
    """Shard of a key: the smallest -ln(u) / weight wins, u uniform from key and shard.

    Shards are numbered in the order of weights; on equal draws the smaller number wins. A
    shard of weight 0 gets nothing. The expected share of a shard is its share of the weights.
    """
    if not weights or min(weights) < 0 or max(weights) <= 0:
        raise ValueError("weights must not be negative, and one must be positive")
    text = F.coalesce(key.cast("string"), F.lit("null"))
    scale = float(16**DRAW_DIGITS)
    draws = [
        F.struct(
            (-F.log((_draw(text, shard) + 0.5) / scale) / weight).alias("cost"),
            F.lit(shard).alias("shard"),
        )
        for shard, weight in enumerate(weights)
        if weight > 0
    ]
    best = F.least(*draws) if len(draws) > 1 else draws[0]
    return best["shard"]


def shard_records(
    rows: DataFrame,
    weights: Sequence[float],
    grown_weights: Sequence[float] | None = None,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Key, size, CRC-32 of the text, shard, slot in the shard, and shard after growth.

    Slots of a shard run from 0 without gaps, by part of the shard, then key, then CRC and
    size. Equal rows are counted before they are numbered, so however many there are, a task
    sees one row of them. No shard passes through one task: parts are numbered on their own
    and shifted by the rows of the parts before, which are counted over the parts alone.
    """
    content = text_or_empty(F.col(text)).cast("binary")
    records = rows.select(
        F.col(key).alias("key"),
        (F.octet_length(content) + 1).cast("long").alias("size"),
        F.crc32(content).alias("text_crc32"),
    )
    counted = records.groupBy("key", "size", "text_crc32").agg(F.count("*").alias("copies"))
    name = F.concat_ws(
        ":", F.coalesce(F.col("key").cast("string"), F.lit("null")), F.col("text_crc32")
    )
    part = F.conv(F.substring(F.md5(name.cast("binary")), 1, 8), 16, 10).cast("long")
    placed = counted.select(
        "*",
        rendezvous_shard(F.col("key"), weights).alias("shard"),
        rendezvous_shard(F.col("key"), grown_weights or weights).alias("grown_shard"),
        (part % SLOT_PARTS).cast("int").alias("part"),
    )
    in_part = (
        Window.partitionBy("shard", "part")
        .orderBy("key", "text_crc32", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before_part = (
        Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    )
    parts = (
        placed.groupBy("shard", "part")
        .agg(F.sum("copies").alias("rows"))
        .select(
            "shard", "part", F.coalesce(F.sum("rows").over(before_part), F.lit(0)).alias("shift")
        )
    )
    # at most len(weights) * SLOT_PARTS rows
    shifted = placed.join(F.broadcast(parts), ["shard", "part"])
    first = F.col("shift") + F.coalesce(F.sum("copies").over(in_part), F.lit(0))
    return shifted.withColumn("first", first).select(
        F.col("key").alias(key),
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        F.explode(F.sequence(F.col("first"), F.col("first") + F.col("copies") - 1)).alias("slot"),
        "grown_shard",
    )
