"""Exact top-k search by inner product: a three-phase uniform threshold over score lists.

A vector is cut into fragments; a fragment's inner products with a query form a score list,
and a vector's score is the sum over its lists. First, each block of vectors gives the leading
entries of its lists; their whole scores give every query a cutoff that at least k vectors
reach. Second, the cutoff goes to all blocks; a vector can only reach it if one of its
fragments reaches the cutoff's equal share, so each list gives its entries of that size.
Third, the whole scores of those entries are resolved, and what reaches the cutoff is ranked.

Vectors become whole numbers, floor(scale * x). Edge cases: vectors of any length are compared whole; vectors that are null, or hold a null or
non-finite component, and rows with a null id take no part; a query is scored against vectors
of its own length only; every row is a vector of its own, so of several rows with one id each
is a candidate for the others, and each query among them gets its own ranks; a query without
another vector of its length has no rows; equal scores go by the smaller id, and rows equal in
both are alike; a score that needs more than 63 bits wraps as Spark's long arithmetic does; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from hitledger.llm.tables import stored

#: Vectors, and queries, that a task holds as one matrix.
BLOCK_ROWS = 4096
#: Queries scored at once inside a block; bounds a task's score matrix.
SLICE_QUERIES = 256
FRAGMENTS = 2
#: Whole numbers below this are exact as doubles.
EXACT = float(1 << 53)
#: Sums of products below this don't wrap.
WRAPS = float(1 << 62)


def _whole(components: Column, scale: int) -> Column:
    return F.transform(components, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def usable_vectors(rows: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """Row number, id and components as whole numbers, without unusable vectors.

    Row numbers hold for one evaluation only; store the rows to keep them.
    """
    components = F.col(vector)
    bad = F.exists(
        components,
        lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == np.inf),
    )
    return rows.where(F.col(key).isNotNull() & components.isNotNull() & ~bad).select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).cast("long").alias("id"),
        _whole(components, scale).alias("v"),
    )


def _blocks(vectors: DataFrame, name: str) -> DataFrame:
    """Vectors numbered into blocks of about BLOCK_ROWS, by length of the vector."""
    sized = vectors.withColumn("dims", F.size("v"))
    counts = sized.groupBy("dims").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("n"))
    # one row per vector length; small enough or joined by shuffle, as Spark sees fit
    placed = sized.join(counts, "dims")
    return placed.withColumn(name, F.pmod(F.xxhash64("row"), F.col("n")).cast("int"))


def _beside(blocks: DataFrame, others: DataFrame, name: str) -> DataFrame:
    """Copies of blocks for every block of the others with vectors of the same length."""
    counts = others.select("dims", F.col("n").alias("others")).distinct()
    each = F.explode(F.sequence(F.lit(0), F.col("others") - 1))
    return blocks.join(counts, "dims").withColumn(name, each)


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64, copy=False).reshape(len(column), dims)


def _bound(queries: np.ndarray, vectors: np.ndarray) -> float:
    """No sum of products of the rows is larger."""
    largest = [np.abs(rows.astype(float)).max(initial=0) for rows in (queries, vectors)]
    return largest[0] * largest[1] * max(1, queries.shape[1])


def _products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products as whole numbers, by floating point where that is exact."""
    if _bound(queries, vectors) < EXACT:
        return (queries.astype(float) @ vectors.astype(float).T).astype(np.int64)
    return queries @ vectors.T


def _lists(queries: np.ndarray, vectors: np.ndarray, fragments: int) -> list[np.ndarray]:
    edges = np.linspace(0, queries.shape[1], fragments + 1).astype(int)
    return [
        _products(queries[:, a:b], vectors[:, a:b])
        for a, b in zip(edges[:-1], edges[1:], strict=True)
    ]


def _leading(scores: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k largest entries of every row, in no order."""
    if scores.shape[1] <= k:
        return np.broadcast_to(np.arange(scores.shape[1]), scores.shape)
    return np.argpartition(-scores, k - 1, axis=1)[:, :k]


def first_lists(k: int, fragments: int):
    """Phase 1 in one pair of blocks: whole scores of the leading entries of every list."""

    def gather(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        out_q, out_v, out_s = [], [], []
        if len(queries) and len(vectors):
            dims = queries.column("dims")[0].as_py()
            q_rows, v_rows = queries.column("row").to_numpy(), vectors.column("row").to_numpy()
            v_ids = vectors.column("id").to_numpy()
            q, v = _matrix(queries.column("v"), dims), _matrix(vectors.column("v"), dims)
            for at in range(0, len(q), SLICE_QUERIES):
                rows = slice(at, at + SLICE_QUERIES)
                lists = _lists(q[rows], v, fragments)
                total = sum(lists)
                own = q_rows[rows, None] == v_rows[None, :]
                picked = np.zeros(total.shape, dtype=bool)
                for scores in lists:
                    # one more than k, as the query's own row may lead a list
                    np.put_along_axis(picked, _leading(scores, k + 1), True, axis=1)
                i, j = np.nonzero(picked & ~own)
                # the k best of them are enough for the k-th best of all blocks' entries
                s = total[i, j]
                order = np.lexsort((v_ids[j], -s, i))
                i, j, s = i[order], j[order], s[order]
                rank = np.arange(len(i)) - np.searchsorted(i, i)
                keep = rank < k
                out_q.append(q_rows[rows][i[keep]])
                out_v.append(v_ids[j[keep]])
                out_s.append(s[keep])
        return _answer(out_q, out_v, out_s)

    return gather


def entries_above(fragments: int):
    """Phases 2 and 3 in one pair of blocks: list entries of the cutoff's share, resolved."""

    def gather(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        out_q, out_v, out_s = [], [], []
        if len(queries) and len(vectors):
            dims = queries.column("dims")[0].as_py()
            q_rows, v_rows = queries.column("row").to_numpy(), vectors.column("row").to_numpy()
            v_ids = vectors.column("id").to_numpy()
            low = queries.column("cutoff").to_numpy()
            q, v = _matrix(queries.column("v"), dims), _matrix(vectors.column("v"), dims)
            for at in range(0, len(q), SLICE_QUERIES):
                rows = slice(at, at + SLICE_QUERIES)
                lists = _lists(q[rows], v, fragments)
                cutoff = low[rows, None]
                # a sum reaches the cutoff only if a part reaches the floor of its share
                enough = lists[0] >= cutoff // fragments
                for scores in lists[1:]:
                    enough |= scores >= cutoff // fragments
                if _bound(q[rows], v) >= WRAPS:  # parts say nothing about a wrapped sum
                    enough[:] = True
                i, j = np.nonzero(enough)
                total = sum(scores[i, j] for scores in lists)
                keep = (total >= low[rows][i]) & (q_rows[rows][i] != v_rows[j])
                out_q.append(q_rows[rows][i[keep]])
                out_v.append(v_ids[j[keep]])
                out_s.append(total[keep])
        return _answer(out_q, out_v, out_s)

    return gather


def _answer(*parts: list[np.ndarray]) -> pa.Table:
    columns = [
        np.concatenate(part).astype(np.int64) if part else np.empty(0, np.int64) for part in parts
    ]
    return pa.table(dict(zip(("row", "vec_id", "score"), columns, strict=True)))


SCORES = "row long, vec_id long, score long"


def _scored(queries: DataFrame, vectors: DataFrame, score) -> DataFrame:
    keys = ["dims", "q_block", "v_block"]
    left, right = _beside(queries, vectors, "v_block"), _beside(vectors, queries, "q_block")
    left = left.select(*[F.col(name).alias(name) for name in left.columns])  # own columns
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(score, SCORES)


def _best(scores: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    rows: DataFrame,
    is_query: Column,
    k: int = 20,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = 64,
    fragments: int = FRAGMENTS,
) -> DataFrame:
    """query_id, rank from 1, vec_id, score: the k best other vectors of every query.

    is_query: condition on a column named like key. Work is queries x vectors, done in pairs
    of blocks that are spread over the cluster; a pair needs memory for two blocks and one
    slice of scores, and hands on about k entries a query.
    """
    vectors = stored(usable_vectors(rows, key, vector, scale), "vectors")
    blocks = _blocks(vectors, "v_block")
    chosen = vectors.withColumn(key, F.col("id")).where(is_query).select("row", "id", "v")
    queries = _blocks(chosen, "q_block")
    first = _best(_scored(queries, blocks, first_lists(k, fragments)), k)
    lowest = F.when(F.count("*") >= k, F.min("score")).otherwise(F.lit(-(1 << 62)))
    cutoffs = first.groupBy("row").agg(lowest.alias("cutoff"))
    sent = queries.join(cutoffs, "row")
    found = _best(_scored(sent, blocks, entries_above(fragments)), k)
    named = found.join(chosen.select("row", F.col("id").alias("query_id")), "row")
    return named.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
