"""Ranked lexical search: bit-sliced Bloom signatures bound the scores, exact scores decide.

Every document has a Bloom signature of its terms, and of how often they occur: a term is entered
once for each level of LEVELS that its count reaches. Signatures of documents of like size form
a block, stored by bit position, so that a slice is a bitmap over the block's documents. The
slices of a term's bits, combined by AND, overestimate the documents that hold it at a level; the
largest count below the next level gives the most that the term can add to a score. Sums of
these, weighted, are upper bounds of all scores.

Some documents with the highest bounds are scored exactly, and the k-th best of these scores is
a cutoff. Then every document whose bound reaches the cutoff, and so every one not provably
excluded, is scored exactly and ranked. The index is made by one pass over the texts without a
shuffle, and does not depend on the items.

Scores are whole numbers: N documents hold a term, L terms are in all, n in a document, df
documents hold a term, tf times. w = floor(1000 * ln((2N + 2) / (2df + 1))),
m = 50 + (50 * n * N) div L, and a term adds w * ((10**9 * tf) div (1000 * tf + 20 * m)).

Edge cases: null text counts as empty, and a document or item without terms has no rows; a null
key is a key like any other, and sorts last; each row of either table counts for itself, so
repeated rows are ranked one after another; equal scores go by the smaller key; fewer than k
documents with a score above 0 give as many rows; a very long text is worked on alone and whole,
and beyond some 80,000 entries its signature gets denser, which makes its bounds higher, not
wrong; an empty table gives an empty result; other columns are not read. A term is known by a
hash of 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from hitledger.llm.tables import stored, text_or_empty
from hitledger.llm.words import NOT_ALNUM, chunks, mix, slices, split_words

#: Counts from which a term has one more entry: 1 to 8, then 10, 12, 14, 16, 20, 24, 28, 32 and so on.
LEVELS = np.array([*range(1, 8), *(b * a // 4 for b in (2**i for i in range(3, 30)) for a in range(4, 8))])
#: Bits an entry sets, and bits of signature for each entry at least.
HASHES = 5
ROOM = 16
LEAST_WIDTH, MOST_WIDTH = 256, 1 << 20
#: Bits of a block, and documents of it, at most.
BLOCK_BITS = 1 << 22
BLOCK_DOCUMENTS = 1024
#: Times k documents are scored to find the cutoff: with k of them alone, those whose bounds are
#: furthest too high would set it.
FIRST_TIMES = 4
#: Terms of items that one pass over the index serves, about; they are sent to every task.
PASS_TERMS = 1 << 15
#: Terms whose slices are combined at once.
CHUNK_TERMS = 1024
#: Documents to score up to this number are sent to all executors (a key and a short list each),
#: more are joined by shuffle.
BROADCAST_KEYS = 200_000

_SPREAD = np.uint64(0xD6E8FEB86659FD93)


def term_counts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of every text, and text, hash and count of each of its distinct terms, in that order."""
    words = split_words(texts, NOT_ALNUM)
    owner = np.repeat(np.arange(len(texts)), np.diff(words.offsets))
    order = np.lexsort((words.hashes, owner))
    owner, hashes = owner[order], words.hashes[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return np.diff(words.offsets), owner[at], hashes[at], np.diff(np.append(at, len(hashes)))


def bit_positions(hashes: np.ndarray, levels: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """The HASHES bits that each term sets at a level in a signature; widths are powers of two."""
    entry = mix(hashes + levels.astype(np.uint64) * _SPREAD)
    step = (entry >> np.uint64(32)) | np.uint64(1)
    found = entry[:, None] + np.arange(HASHES, dtype=np.uint64) * step[:, None]
    return (found & (widths.astype(np.uint64) - np.uint64(1))[:, None]).astype(np.int64)


def signature_widths(entries: np.ndarray) -> np.ndarray:
    """Bits for documents with so many entries: a power of two, so that like sizes share a block."""
    room = np.clip(entries * ROOM, LEAST_WIDTH, MOST_WIDTH)
    return 1 << np.ceil(np.log2(room)).astype(np.int64)


def entries_of(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of terms and their counts: how many levels each reaches, and every entry's term and level."""
    reached = np.searchsorted(LEVELS, counts, side="right")
    levels = np.arange(reached.sum()) - np.repeat(np.cumsum(reached) - reached, reached)
    return reached, np.repeat(hashes, reached), levels


def capacity(width: int) -> int:
    return max(8, min(BLOCK_DOCUMENTS, BLOCK_BITS // width))


@dataclass
class Block:
    """Signatures of one width, under construction."""

    width: int
    bits: np.ndarray = field(init=False)
    keys: list = field(default_factory=list)
    sizes: list = field(default_factory=list)
    terms: list = field(default_factory=list)

    def __post_init__(self) -> None:
        self.bits = np.zeros((self.width, capacity(self.width)), dtype=bool)

    def add(self, key, size: int, hashes: np.ndarray, bits: np.ndarray) -> None:
        self.bits[bits, len(self.keys)] = True
        self.keys.append(key)
        self.sizes.append(size)
        self.terms.append(hashes)

    def row(self) -> dict:
        found, documents = np.unique(np.concatenate(self.terms), return_counts=True)
        packed = np.packbits(self.bits[:, : len(self.keys)], axis=1)
        return {
            "width": self.width,
            "keys": self.keys,
            "sizes": self.sizes,
            "slices": packed.tobytes(),
            "terms": found.view(np.int64),
            "in_documents": documents,
        }


def _blocks(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    open_blocks: dict[int, Block] = {}
    for batch in batches:
        for part in slices(batch, 1):
            keys = part.column(0).to_pylist()
            texts = [value.encode("utf-8", "surrogatepass") for value in part.column(1).to_pylist()]
            for run in chunks([len(text) for text in texts]):
                sizes, owner, hashes, counts = term_counts(texts[run.start : run.stop])
                reached, terms, levels = entries_of(hashes, counts)
                of_entry = np.repeat(owner, reached)
                widths = signature_widths(np.bincount(of_entry, minlength=len(run)))
                bits = bit_positions(terms, levels, widths[of_entry])
                places = np.arange(len(run) + 1)
                first, first_entry = np.searchsorted(owner, places), np.searchsorted(of_entry, places)
                for i in np.flatnonzero(sizes):
                    width = int(widths[i])
                    if width not in open_blocks:
                        open_blocks[width] = Block(width)
                    block = open_blocks[width]
                    block.add(
                        keys[run.start + i],
                        int(sizes[i]),
                        hashes[first[i] : first[i + 1]],
                        bits[first_entry[i] : first_entry[i + 1]].ravel(),
                    )
                    if len(block.keys) == capacity(width):
                        yield pa.RecordBatch.from_pylist([open_blocks.pop(width).row()], schema)
    for block in open_blocks.values():
        yield pa.RecordBatch.from_pylist([block.row()], schema)


def build_index(rows: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Blocks of signatures over all documents with a term, stored below the shared folder."""
    picked = rows.select(F.col(key).alias("key"), text_or_empty(F.col(text)).alias("text"))
    kind = picked.schema["key"].dataType.simpleString()
    schema = (
        f"width int, keys array<{kind}>, sizes array<long>, slices binary, terms array<long>,"
        " in_documents array<long>"
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        arrow = pa.schema(
            {
                "width": pa.int32(),
                "keys": pa.list_(first.schema.field(0).type),
                "sizes": pa.list_(pa.int64()),
                "slices": pa.binary(),
                "terms": pa.list_(pa.int64()),
                "in_documents": pa.list_(pa.int64()),
            }
        )
        yield from _blocks(_chained(first, batches), arrow)

    return stored(picked.mapInArrow(build, schema), "signatures")


def _chained(first, rest):
    yield first
    yield from rest


@dataclass
class Query:
    """Some items: distinct terms with weights, and each item's places among them."""

    terms: np.ndarray
    weights: np.ndarray
    items: list[np.ndarray]
    documents: int
    all_terms: int

    def norms(self, sizes: np.ndarray) -> np.ndarray:
        return 50 + 50 * sizes * self.documents // self.all_terms

    def most(self, norms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """By number of levels reached and document: what a weight is multiplied by at most."""
        above = np.append(LEVELS[1:] - 1, np.iinfo(np.int32).max)
        counts = np.minimum(above[:, None], sizes[None, :])
        found = 10**9 * counts // (1000 * counts + 20 * norms[None, :])
        return np.concatenate([np.zeros((1, len(sizes)), dtype=np.int64), found])

    def exact(self, item: int, hashes: np.ndarray, counts: np.ndarray, norm: int) -> int:
        """Score of a document with these distinct terms, in order of their hashes."""
        wanted = self.items[item]
        at = np.searchsorted(hashes, self.terms[wanted])
        at[at == len(hashes)] = 0
        held = hashes[at] == self.terms[wanted]
        found = counts[at[held]].astype(np.int64)
        return int((self.weights[wanted[held]] * (10**9 * found // (1000 * found + 20 * norm))).sum())

    def bounds(self, width: int, sizes: np.ndarray, packed: bytes) -> np.ndarray:
        """Upper bounds of the scores, items by documents of a block."""
        planes = np.frombuffer(packed, dtype=np.uint8).reshape(width, -1)
        most = self.most(self.norms(sizes), sizes)
        out = np.zeros((len(self.items), len(sizes)), dtype=np.int64)
        across = np.arange(len(sizes))
        for begin in range(0, len(self.terms), CHUNK_TERMS):
            terms = self.terms[begin : begin + CHUNK_TERMS]
            reached = np.zeros((len(terms), len(sizes)), dtype=np.int8)
            active, held = np.arange(len(terms)), None
            for level in range(len(LEVELS)):
                same = np.full(len(active), level), np.full(len(active), width)
                at = bit_positions(terms[active], *same)
                found = planes[at[:, 0]]
                for k in range(1, HASHES):
                    found = found & planes[at[:, k]]
                if held is not None:  # whoever reaches a level has reached the one below
                    found &= held
                some = found.any(axis=1)
                active, held = active[some], found[some]
                if not len(active):
                    break
                reached[active] += np.unpackbits(held, axis=1, count=len(sizes)).view(np.int8)
            adds = most[reached, across] * self.weights[begin : begin + CHUNK_TERMS, None]
            for i, places in enumerate(self.items):
                low, high = np.searchsorted(places, (begin, begin + CHUNK_TERMS))
                if low < high:
                    out[i] += adds[places[low:high] - begin].sum(axis=0)
        return out


def _block_columns(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.Array, np.ndarray, bytes]]:
    for i in range(len(batch)):
        yield (
            batch.column(0)[i].as_py(),
            batch.column(1)[i].values,
            batch.column(2)[i].values.to_numpy(),
            batch.column(3)[i].as_buffer(),
        )


def _found(items: np.ndarray, keys: pa.Array, schema: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(items.astype(np.int32)), keys], schema)


def highest_bounds(query: Query, k: int):
    """item and key of the k highest bounds above 0 in the blocks of one task."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.zeros((len(query.items), 0), dtype=np.int64)
        places = np.zeros((len(query.items), 0), dtype=np.int64)
        keys, seen = [], 0
        for batch in batches:
            for width, block_keys, sizes, packed in _block_columns(batch):
                bounds = np.concatenate([best, query.bounds(width, sizes, packed)], axis=1)
                here = np.broadcast_to(np.arange(seen, seen + len(sizes)), (len(query.items), len(sizes)))
                at = np.concatenate([places, here], axis=1)
                seen += len(sizes)
                keys.append(block_keys)
                if bounds.shape[1] > k:
                    top = np.argpartition(-bounds, k - 1, axis=1)[:, :k]
                    bounds, at = np.take_along_axis(bounds, top, 1), np.take_along_axis(at, top, 1)
                best, places = bounds, at
        if keys:
            i, j = np.nonzero(best > 0)
            found = pa.concat_arrays(keys).take(pa.array(places[i, j]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(i.astype(np.int32)), found, pa.array(best[i, j])], ["item", "key", "bound"]
            )

    return scan


def bounds_above(query: Query, cutoffs: np.ndarray):
    """item and key of all documents whose bound reaches the item's cutoff."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for width, keys, sizes, packed in _block_columns(batch):
                i, j = np.nonzero(query.bounds(width, sizes, packed) >= cutoffs[:, None])
                yield _found(i, keys.take(pa.array(j)), ["item", "key"])

    return scan


def exact_scores(query: Query, cutoffs: np.ndarray):
    """item, key and score, from rows of key, text and items; what stays below the cutoff goes."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                texts = [value.encode("utf-8", "surrogatepass") for value in part.column(1).to_pylist()]
                wanted = part.column(2).to_pylist()
                items, rows, scores = [], [], []
                for run in chunks([len(text) for text in texts]):
                    sizes, owner, hashes, counts = term_counts(texts[run.start : run.stop])
                    edges = np.searchsorted(owner, np.arange(len(run) + 1))
                    norms = query.norms(sizes)
                    for i in np.flatnonzero(sizes):
                        inside = slice(edges[i], edges[i + 1])
                        for item in wanted[run.start + i]:
                            found = query.exact(item, hashes[inside], counts[inside], int(norms[i]))
                            if found >= cutoffs[item]:
                                items.append(item)
                                rows.append(run.start + i)
                                scores.append(found)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(items, pa.int32()),
                        part.column(0).take(pa.array(rows, pa.int64())),
                        pa.array(scores, pa.int64()),
                    ],
                    ["item", "key", "score"],
                )

    return score


def _resolved(documents: DataFrame, candidates: DataFrame, query: Query, cutoffs: np.ndarray) -> DataFrame:
    """Exact scores of the candidates; a key brings all rows that have it."""
    wanted = stored(candidates.groupBy("key").agg(F.collect_set("item").alias("items")), "candidates")
    wanted = wanted.withColumnRenamed("key", "wanted")
    if wanted.count() <= BROADCAST_KEYS:
        wanted = F.broadcast(wanted)
    kind = documents.schema["key"].dataType.simpleString()
    paired = documents.join(wanted, F.col("key").eqNullSafe(F.col("wanted"))).select("key", "text", "items")
    return paired.mapInArrow(exact_scores(query, cutoffs), f"item int, key {kind}, score long")


def _ranked(scores: DataFrame, k: int, by: str) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc(by), F.asc_nulls_last("key"))
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _item_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """Row number, key and hashes of the distinct terms of every item with a term."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [value.encode("utf-8", "surrogatepass") for value in batch.column(2).to_pylist()]
            found = [term_counts([text])[2].view(np.int64) for text in texts]
            terms = pa.array(found, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], terms], ["row", "item_key", "terms"])

    picked = items.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("item_key"),
        text_or_empty(F.col(text)).alias("text"),
    )
    kind = picked.schema["item_key"].dataType.simpleString()
    found = picked.mapInArrow(take, f"row long, item_key {kind}, terms array<long>")
    return stored(found.where(F.size("terms") > 0), "items")


def _weights(index: DataFrame, items: DataFrame, documents: int) -> DataFrame:
    """term and weight of the items' terms that some document holds."""
    wanted = items.select(F.explode("terms").alias("term")).distinct()
    in_block = F.explode(F.arrays_zip("terms", "in_documents")).alias("t")
    each = index.select(in_block).select(F.col("t.terms").alias("term"), "t.in_documents")
    counted = each.join(wanted, "term").groupBy("term").agg(F.sum("in_documents").alias("df"))
    ratio = F.lit(2 * documents + 2) / (2 * F.col("df") + 1)
    return stored(counted.select("term", F.floor(1000 * F.log(ratio)).cast("long").alias("weight")), "weights")


def _query_of(rows: list, weights: dict[int, int], documents: int, all_terms: int) -> Query:
    terms = np.array(sorted({t for row in rows for t in row["terms"] if t in weights}), dtype=np.int64)
    place = {int(term): i for i, term in enumerate(terms)}
    return Query(
        terms.view(np.uint64),
        np.array([weights[int(term)] for term in terms], dtype=np.int64),
        [np.array(sorted(place[t] for t in row["terms"] if t in place), dtype=np.int64) for row in rows],
        documents,
        all_terms,
    )


def search(
    rows: DataFrame,
    items: DataFrame,
    k: int = 50,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    index: DataFrame | None = None,
) -> DataFrame:
    """item_key, rank from 1, key and score of the k best documents of every item.

    index: what build_index made of the same rows, for use with several sets of items. Items are
    served in passes of about PASS_TERMS terms; a pass sends its terms to the tasks, reads the
    index twice, and the texts of its candidates.
    """
    index = build_index(rows, key, text) if index is None else index
    documents = rows.select(F.col(key).alias("key"), text_or_empty(F.col(text)).alias("text"))
    kind = documents.schema["key"].dataType.simpleString()
    totals = index.agg(
        F.sum(F.size("sizes").cast("long")), F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))
    ).first()
    named = _item_terms(items, item_key, item_text)
    n_terms = named.agg(F.sum(F.size("terms"))).first()[0]
    item_kind = named.schema["item_key"].dataType.simpleString()
    empty = f"{item_key} {item_kind}, rank int, {key} {kind}, score long"
    if not totals[0] or not n_terms:
        return rows.sparkSession.createDataFrame([], empty)
    weights = _weights(index, named, totals[0])
    passes = -(-n_terms // PASS_TERMS)
    blocks = index.select("width", "keys", "sizes", "slices")
    results = []
    for number in range(passes):
        mine = named.where(F.pmod(F.xxhash64("row"), F.lit(passes)) == number)
        held = mine.select(F.explode("terms").alias("term")).distinct().join(weights, "term")
        # both are bounded by the terms of a pass
        by_term = {r["term"]: r["weight"] for r in held.collect()}
        picked = sorted(mine.collect(), key=lambda r: r["row"])
        query = _query_of(picked, by_term, *totals)
        if not len(query.terms):
            continue
        most = FIRST_TIMES * k
        leading = blocks.mapInArrow(highest_bounds(query, most), f"item int, key {kind}, bound long")
        first = _ranked(leading, most, "bound").select("item", "key")
        known = _ranked(_resolved(documents, first, query, np.ones(len(picked), np.int64)), k, "score")
        # one row for each item of the pass
        lowest = known.groupBy("item").agg(F.min("score").alias("score"), F.count("*").alias("n")).collect()
        cutoffs = np.ones(len(picked), dtype=np.int64)
        for r in lowest:
            if r["n"] >= k:
                cutoffs[r["item"]] = r["score"]
        possible = blocks.mapInArrow(bounds_above(query, cutoffs), f"item int, key {kind}")
        best = _ranked(_resolved(documents, possible, query, cutoffs), k, "score")
        numbers = [(i, row["row"]) for i, row in enumerate(picked)]
        of_item = rows.sparkSession.createDataFrame(numbers, "item int, row long").join(named.drop("terms"), "row")
        ranked = best.join(of_item, "item").select(
            F.col("item_key").alias(item_key), F.col("rank").cast("int").alias("rank"),
            F.col("key").alias(key), "score",
        )
        results.append(stored(ranked, "ranked"))
    if not results:
        return rows.sparkSession.createDataFrame([], empty)
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out
