"""Hard negatives by a vertical scan over columnar vectors that shrinks the candidates as it goes.

Vectors are stored in blocks, dimension by dimension, with each dimension's least and largest
value. For an anchor the dimensions are read in descending magnitude of the anchor's own
components. What a candidate has gained so far, and the least and most that the remaining
dimensions can add, bound its score. A candidate that can no longer matter leaves the bitmap;
whoever is left when all dimensions are read has an exact score.

The first scan finds each anchor's positives, its best rows of the same label: a candidate goes
when its upper bound is below the k-th best lower bound. The second finds negatives, rows of
other labels whose scores lie in a window given by a positive's score: a candidate goes when its
bounds miss all windows, or when in each window it could be in, k candidates that are surely
inside are surely better.

Vectors become whole numbers, floor(scale * x). Edge cases: rows with a null id, label or vector,
or with a null or non-finite component take no part; only vectors of the same length meet; every
row counts for itself, so of rows that share an id each is an anchor, a positive or a negative of
its own; an anchor without a positive, and a positive without a row in its window, as with
negative scores, has no rows; equal scores go by the smaller id, and rows equal in both are
alike; scores beyond 63 bits wrap as Spark's long arithmetic does; empty vectors score 0; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from hitledger.llm.tables import stored

#: Vectors of a block, and anchors, at most about; fewer when they are long.
BLOCK_ROWS, ANCHOR_ROWS = 8192, 256
#: Components of a block at most about.
BLOCK_VALUES = 1 << 22
#: Dimensions read between two looks at the bounds.
STEP = 8
#: Sums below the first are exact as doubles, below the second they don't wrap.
EXACT, WRAPS = float(1 << 53), float(1 << 62)

Keep = Callable[[np.ndarray, np.ndarray], np.ndarray]


def usable_vectors(rows: DataFrame, key: str, label: Column, vector: str, scale: int) -> DataFrame:
    """row (holds once stored), id, label and components as whole numbers."""
    components = F.col(vector)
    bad = F.exists(
        components,
        lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == np.inf),
    )
    whole = F.transform(components, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    usable = F.col(key).isNotNull() & label.isNotNull() & components.isNotNull() & ~bad
    return rows.where(usable).select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).cast("long").alias("id"),
        label.cast("long").alias("label"),
        whole.alias("v"),
    )


def _narrow(values: np.ndarray) -> np.ndarray:
    least, most = values.min(initial=0), values.max(initial=0)
    for kind in (np.int8, np.int16, np.int32):
        if np.iinfo(kind).min <= least and most <= np.iinfo(kind).max:
            return values.astype(kind)
    return values


def _columnar(rows: pa.Table) -> pa.Table:
    """One row with the whole block, its vectors by dimension in the narrowest type."""
    dims, block = rows.column("dims")[0].as_py(), rows.column("block")[0].as_py()
    flat = rows.column("v").combine_chunks().flatten().to_numpy()
    columns = flat.reshape(len(rows), dims).T
    narrow = _narrow(np.ascontiguousarray(columns))
    found = {
        "dims": dims,
        "block": block,
        "rows": rows.column("row").to_numpy(),
        "ids": rows.column("id").to_numpy(),
        "labels": rows.column("label").to_numpy(),
        "bytes_each": narrow.dtype.itemsize,
        "columns": narrow.tobytes(),
        "lows": columns.min(axis=1, initial=np.iinfo(np.int64).max),
        "highs": columns.max(axis=1, initial=np.iinfo(np.int64).min),
        "scores": rows.column("scores").to_pylist(),
    }
    return pa.Table.from_pylist([found], BLOCK_SCHEMA)


BLOCK_SCHEMA = pa.schema(
    {
        "dims": pa.int32(),
        "block": pa.int32(),
        "rows": pa.list_(pa.int64()),
        "ids": pa.list_(pa.int64()),
        "labels": pa.list_(pa.int64()),
        "bytes_each": pa.int32(),
        "columns": pa.binary(),
        "lows": pa.list_(pa.int64()),
        "highs": pa.list_(pa.int64()),
        "scores": pa.list_(pa.list_(pa.int64())),
    }
)
BLOCK_TYPE = (
    "dims int, block int, rows array<long>, ids array<long>, labels array<long>, bytes_each int,"
    " columns binary, lows array<long>, highs array<long>, scores array<array<long>>"
)


def _blocks(vectors: DataFrame, most_rows: int, label: str) -> DataFrame:
    """Vectors of a length in blocks of about most_rows; a length with many rows has many blocks."""
    sized = vectors.withColumn("dims", F.size("v"))
    if "scores" not in vectors.columns:
        sized = sized.withColumn("scores", F.lit(None).cast("array<long>"))
    fit = F.least(F.lit(most_rows), F.greatest(F.lit(64), F.lit(BLOCK_VALUES) / F.greatest("dims", F.lit(1))))
    counts = sized.groupBy("dims").agg(F.count("*").alias("n")).withColumn("n", F.ceil(F.col("n") / fit))
    placed = sized.join(counts, "dims").withColumn("block", F.pmod(F.xxhash64("row"), F.col("n")).cast("int"))
    made = placed.drop("n").groupBy("dims", "block").applyInArrow(_columnar, BLOCK_TYPE)
    return stored(made, label)


def _pairs(anchors: DataFrame, blocks: DataFrame) -> DataFrame:
    """Every block of anchors beside every block of vectors of the same length, one row each."""
    keys = ["dims", "anchor_block", "vector_block"]
    mine = anchors.select("dims", F.col("block").alias("anchor_block"))
    theirs = blocks.select("dims", F.col("block").alias("vector_block"))
    # block numbers only: a row for each pair of blocks, of which each is a task's worth of work
    numbers = mine.join(theirs, "dims")
    session = blocks.sparkSession
    least = max(4 * session.sparkContext.defaultParallelism, int(session.conf.get("spark.sql.shuffle.partitions")))
    tasks = max(1, min(numbers.count(), least))
    left = anchors.withColumnRenamed("block", "anchor_block").join(numbers, ["dims", "anchor_block"])
    right = blocks.withColumnRenamed("block", "vector_block").join(numbers, ["dims", "vector_block"])

    def whole(side: DataFrame, name: str) -> DataFrame:
        return side.select(*keys, F.struct(*[c for c in side.columns if c not in keys]).alias(name))

    # a row is a whole block, so partitions are counted by rows and not by bytes
    return (
        whole(left, "anchors").repartition(tasks, *keys).join(whole(right, "vectors").repartition(tasks, *keys), keys)
    )


class _Block:
    """A block taken out of a row of a batch."""

    def __init__(self, dims: int, block: pa.StructScalar):
        self.rows, self.ids, self.labels, self.lows, self.highs = (
            block[name].values.to_numpy() for name in ("rows", "ids", "labels", "lows", "highs")
        )
        kind = np.dtype(f"i{block['bytes_each'].as_py()}")
        self.columns = np.frombuffer(block["columns"].as_buffer(), kind).reshape(dims, len(self.rows))
        self.scores = block["scores"].as_py()
        self.largest = max(np.abs(self.lows.astype(float)).max(initial=0), np.abs(self.highs.astype(float)).max(initial=0))


def vertical_scan(
    anchor: np.ndarray, columns: np.ndarray, lows: np.ndarray, highs: np.ndarray, live: np.ndarray, keep: Keep | None
) -> tuple[np.ndarray, np.ndarray]:
    """Candidates that no bound excluded, and their exact scores.

    live: places of the candidates to begin with; keep: from lower and upper bounds, which stay.
    """
    order = np.argsort(-np.abs(anchor.astype(float)), kind="stable")
    ends = np.stack([anchor * lows, anchor * highs])
    rest_low = np.append(np.cumsum(ends.min(axis=0)[order][::-1])[::-1], 0)
    rest_high = np.append(np.cumsum(ends.max(axis=0)[order][::-1])[::-1], 0)
    gained = np.zeros(len(live), dtype=columns.dtype)
    whole = len(live) == columns.shape[1]
    for begin in range(0, len(order), STEP):
        dims = order[begin : begin + STEP]
        part = columns[dims] if whole else columns[np.ix_(dims, live)]
        gained += anchor[dims] @ part
        if keep is not None:
            at = min(begin + STEP, len(order))
            stay = keep(gained + rest_low[at], gained + rest_high[at])
            if not stay.all():
                live, gained, whole = live[stay], gained[stay], False
                if not len(live):
                    break
    return live, gained.astype(np.int64)


def _kth(values: np.ndarray, k: int) -> float:
    return np.partition(values, len(values) - k)[len(values) - k]


def keep_best(k: int) -> Keep:
    def keep(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        if len(lower) <= k:
            return np.ones(len(lower), dtype=bool)
        return upper >= _kth(lower, k)

    return keep


def window_of(score: int, low: int, high: int) -> tuple[int, int]:
    """Whole scores x with low * score <= 100 * x <= high * score."""
    return -(-low * score // 100), high * score // 100


def keep_in_windows(windows: list[tuple[int, int]], k: int) -> Keep:
    def keep(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        stay = np.zeros(len(lower), dtype=bool)
        for least, most in windows:
            possible = (upper >= least) & (lower <= most)
            surely = (lower >= least) & (upper <= most)
            if np.count_nonzero(surely) > k:
                possible &= upper >= _kth(lower[surely], k)
            stay |= possible
        return stay

    return keep


def _first(k: int, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> np.ndarray:
    return np.lexsort((rows, ids, -scores))[:k]


def _scans(batches: Iterator[pa.RecordBatch], scan: Callable, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Run scan for every anchor of every pair of blocks; it gives arrays, one for each name."""
    for batch in batches:
        for i in range(len(batch)):
            dims = batch.column(0)[i].as_py()
            anchors, block = _Block(dims, batch.column(3)[i]), _Block(dims, batch.column(4)[i])
            most = anchors.largest * block.largest * max(1, dims)
            kind = np.float64 if most < EXACT else np.int64
            columns = block.columns.astype(kind)
            lows, highs = block.lows.astype(kind), block.highs.astype(kind)
            found = []
            for a in range(len(anchors.rows)):
                anchor = anchors.columns[:, a].astype(kind)
                bounded = most < WRAPS

                def run(live, keep, anchor=anchor, bounded=bounded):
                    return vertical_scan(anchor, columns, lows, highs, live, keep if bounded else None)

                found += scan(anchors, a, block, run)
            parts = [np.concatenate(column) for column in zip(*found, strict=True)] if found else [np.empty(0, np.int64)] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int64)) for part in parts], names)


POSITIVES = ["anchor_row", "positive_row", "positive_id", "positive_score"]
NEGATIVES = ["anchor_row", "positive_score", "negative_row", "negative_id", "negative_score"]


def _ddl(names: list[str]) -> str:
    return ", ".join(f"{name} long" for name in names)


def best_of_label(k: int):
    """The k best other rows of the anchor's label in a pair of blocks."""

    def scan(anchors: _Block, a: int, block: _Block, run) -> list:
        live = np.flatnonzero((block.labels == anchors.labels[a]) & (block.rows != anchors.rows[a]))
        places, scores = run(live, keep_best(k))
        top = _first(k, block.rows[places], block.ids[places], scores)
        places = places[top]
        return [(np.full(len(top), anchors.rows[a]), block.rows[places], block.ids[places], scores[top])]

    return lambda batches: _scans(batches, scan, POSITIVES)


def best_in_windows(k: int, low: int, high: int):
    """The k best rows of other labels in each of the anchor's windows in a pair of blocks."""

    def scan(anchors: _Block, a: int, block: _Block, run) -> list:
        windows = {score: window_of(score, low, high) for score in anchors.scores[a]}
        windows = {score: window for score, window in windows.items() if window[0] <= window[1]}
        if not windows:
            return []
        live = np.flatnonzero(block.labels != anchors.labels[a])
        places, scores = run(live, keep_in_windows(list(windows.values()), k))
        found = []
        for score, (least, most) in windows.items():
            inside = np.flatnonzero((scores >= least) & (scores <= most))
            at = places[inside]
            top = _first(k, block.rows[at], block.ids[at], scores[inside])
            at, of = at[top], np.full(len(top), score)
            found.append((np.full(len(top), anchors.rows[a]), of, block.rows[at], block.ids[at], scores[inside][top]))
        return found

    return lambda batches: _scans(batches, scan, NEGATIVES)


def _ranked(found: DataFrame, by: list[str], what: str, k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc(f"{what}_score"), f"{what}_id", f"{what}_row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    key: str = "vec_id",
    label: Column | str = "label",
    vector: str = "embedding",
    scale: int = 256,
) -> DataFrame:
    """anchor_id, positive_id, rank from 1, negative_id, positive_score, negative_score.

    is_anchor: condition on a column named like key. low and high: where a negative's score must
    lie, in percent of the positive's. Work is anchors x vectors, done in pairs of blocks that
    are spread over the cluster; a pair needs memory for two blocks and the scores of one
    anchor, and hands on at most k rows for an anchor or a window.
    """
    of_label = F.col(label) if isinstance(label, str) else label
    vectors = stored(usable_vectors(rows, key, of_label, vector, scale), "vectors")
    blocks = _blocks(vectors, BLOCK_ROWS, "columns")
    chosen = vectors.withColumn(key, F.col("id")).where(is_anchor).select("row", "id", "label", "v")
    pairs = _pairs(_blocks(chosen, ANCHOR_ROWS, "anchors"), blocks)
    near = pairs.mapInArrow(best_of_label(positives), _ddl(POSITIVES))
    best = stored(_ranked(near, ["anchor_row"], "positive", positives).drop("rank"), "positives")
    scores = best.groupBy(F.col("anchor_row").alias("row")).agg(F.collect_set("positive_score").alias("scores"))
    asking = _blocks(chosen.join(scores, "row"), ANCHOR_ROWS, "asking")
    inside = _pairs(asking, blocks).mapInArrow(best_in_windows(negatives, low, high), _ddl(NEGATIVES))
    hard = _ranked(inside, ["anchor_row", "positive_score"], "negative", negatives)
    named = best.join(chosen.select(F.col("row").alias("anchor_row"), F.col("id").alias("anchor_id")), "anchor_row")
    return named.join(hard, ["anchor_row", "positive_score"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
        "positive_score", "negative_score",
    )
