"""Near-duplicate groups of texts by b-bit MinHash with links confirmed on whole sets.

A text is the set of its shingles, runs of neighbouring words. Bands of minima propose
candidates; of every minimum a few low bits are kept, packed, and the similarity of candidates
is estimated by counting equal fields, corrected for fields that agree by chance. What the
estimate leaves is bounded by bitmaps of the sets and then confirmed on the sets themselves.

Texts with equal sets are one class, with a number of its own, and only one of them is
compared. Classes that hold rows of one id are linked. Within a bucket of
candidates, two passes keep work and rows small without losing a link: the first proposes a
spanning forest of the candidate pairs, which is confirmed and merged into components; the
second proposes every remaining candidate pair between different components. Both run on
blocks of a bucket, so that no task holds a whole large bucket.

Edge cases: a very long text is worked on alone and whole, some 60 bytes for each of its bytes;
the smallest id of a group wins ties; white space is that of ASCII, and only A to Z are lower-
cased; a text with fewer words than a shingle is one shingle; text that is null or has no words
has no shingles and is linked with nothing but rows of its id; a row with a null id is compared
with nothing, has a null component and is kept; rows that share an id count as linked, whatever
their texts; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from hitledger.llm.components import components
from hitledger.llm.tables import discard, perhaps_among, stored, surely_apart
from hitledger.llm.words import SPACES, chunks, mix, slices, split_words, windows

BANDS, BAND_ROWS = 32, 4
MINIMA = BANDS * BAND_ROWS
#: Low bits kept of each minimum.
FIELD_BITS = 4
#: Standard deviations by which an estimate may fall short of the threshold.
SLACK = 6.0
#: Bits of a set's bitmap for each of its shingles, rounded up to a power of two.
BITMAP_LOAD = 8
#: Members of a bucket that are compared as one block, and rows of a block at once.
BLOCK, SLICE = 1024, 64
#: Words of 64 bits of the bitmaps that are compared at once.
PAIR_WORDS = 1 << 18
#: Numbers that are hashed at once for the minima of one text.
PART = 2048

_seeds = mix(np.arange(1, 2 * MINIMA + 1, dtype=np.uint64))
FACTORS, SHIFTS = _seeds[:MINIMA] | np.uint64(1), _seeds[MINIMA:]


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    encoded = [(text or "").encode("utf-8", "surrogatepass") for text in texts]
    found: list[np.ndarray] = []
    for run in chunks([len(text) for text in encoded]):
        split = split_words([encoded[i] for i in run], SPACES)
        shingles = windows(split.hashes, words)
        for i in range(len(run)):
            first, last = split.offsets[i], split.offsets[i + 1]
            if last - first >= words:
                found.append(np.unique(shingles[first : last - words + 1]))
            elif last > first:
                found.append(windows(split.hashes[first:last], int(last - first)))
            else:
                found.append(np.empty(0, dtype=np.uint64))
    return found


def minima(shingles: np.ndarray) -> np.ndarray:
    """Smallest value of every hash function over a set that is not empty."""
    best = np.full(MINIMA, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), PART):
        values = np.multiply.outer(FACTORS, shingles[at : at + PART])
        values += SHIFTS[:, None]
        np.minimum(best, values.min(axis=1), out=best)
    return best


def packed_fields(values: np.ndarray) -> bytes:
    """The low bits of every minimum, two fields to a byte."""
    low = (mix(values) & np.uint64((1 << FIELD_BITS) - 1)).astype(np.uint8)
    return (low[0::2] | (low[1::2] << 4)).tobytes()


def band_keys(values: np.ndarray) -> np.ndarray:
    rows = values.reshape(BANDS, BAND_ROWS)
    total = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(BAND_ROWS):
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
    return total.view(np.int64)


def bitmap(shingles: np.ndarray) -> bytes:
    """Bits at the shingles modulo a power of two, at least 64 of them."""
    size = 1 << max(6, math.ceil(math.log2(BITMAP_LOAD * len(shingles))))
    bits = np.zeros(size, dtype=bool)
    bits[(shingles & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def estimated_floor(threshold: float) -> int:
    """Equal fields below which a pair is taken for less similar than the threshold."""
    chance = 1 / (1 << FIELD_BITS)
    rate = chance + (1 - chance) * threshold
    spread = math.sqrt(rate * (1 - rate) * MINIMA)
    return math.ceil(rate * MINIMA - SLACK * spread)


def estimated_similarity(equal_fields: np.ndarray) -> np.ndarray:
    """Similarity from the number of equal fields, corrected for agreement by chance."""
    chance = 1 / (1 << FIELD_BITS)
    return np.clip((equal_fields / MINIMA - chance) / (1 - chance), 0, 1)


def equal_fields(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Number of equal fields of packed signatures, given as rows of 64-bit words."""
    differs = left ^ right
    differs |= differs >> np.uint64(2)
    differs |= differs >> np.uint64(1)
    differs &= np.uint64(0x1111111111111111)
    return MINIMA - np.bitwise_count(differs).sum(axis=-1, dtype=np.int64)


class Sketches:
    """Signatures, sizes and bitmaps of the members of one block or pair of blocks."""

    def __init__(self, fields: list[bytes], sizes: np.ndarray, bitmaps: list[bytes]) -> None:
        self.fields = np.frombuffer(b"".join(fields), dtype=np.uint64).reshape(len(fields), -1)
        self.sizes = sizes.astype(np.int64)
        self.widths = np.fromiter(map(len, bitmaps), dtype=np.int64, count=len(bitmaps)) // 8
        self.bitmaps = [np.frombuffer(bits, dtype=np.uint64) for bits in bitmaps]

    def of_width(self, rows: np.ndarray, width: int) -> np.ndarray:
        """Bitmaps of rows, folded to a width not above their own."""
        folded = [
            np.bitwise_or.reduce(self.bitmaps[i].reshape(-1, width), axis=0) for i in rows
        ]
        return np.array(folded, dtype=np.uint64).reshape(len(rows), width)

    def may_link(self, i: np.ndarray, j: np.ndarray, least: Fraction, floor: int) -> np.ndarray:
        """Which pairs pass size, estimate and bitmap; none of the sought ones fails."""
        small, large = np.minimum(self.sizes[i], self.sizes[j]), np.maximum(
            self.sizes[i], self.sizes[j]
        )
        keep = small * least.denominator >= large * least.numerator
        at = np.flatnonzero(keep)
        at = at[equal_fields(self.fields[i[at]], self.fields[j[at]]) >= floor]
        passed = np.zeros(len(i), dtype=bool)
        widths = np.minimum(self.widths[i[at]], self.widths[j[at]])
        for width in np.unique(widths):
            part = at[widths == width]
            used, where = np.unique(np.concatenate((i[part], j[part])), return_inverse=True)
            bits = self.of_width(used, width)
            left, right = where[: len(part)], where[len(part) :]
            for s in range(0, len(part), max(1, PAIR_WORDS // int(width))):
                rows = slice(s, s + max(1, PAIR_WORDS // int(width)))
                a, b = bits[left[rows]], bits[right[rows]]
                # a bit of one set alone shows a shingle of that set alone
                only_a = np.bitwise_count(a & ~b).sum(axis=1, dtype=np.int64)
                only_b = np.bitwise_count(b & ~a).sum(axis=1, dtype=np.int64)
                size_a, size_b = self.sizes[i[part[rows]]], self.sizes[j[part[rows]]]
                shared = np.minimum(size_a - only_a, size_b - only_b)
                union = size_a + size_b - shared
                passed[part[rows]] = shared * least.denominator >= union * least.numerator
        return passed


def _forest(adjacent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of a symmetric relation, grown from the rows with most partners."""
    left, right = [], []
    open_rows = np.ones(len(adjacent), dtype=bool)
    for root in np.argsort(-adjacent.sum(axis=1), kind="stable"):
        if not open_rows[root]:
            continue
        open_rows[root] = False
        waiting = [root]
        while waiting:
            row = waiting.pop()
            new = np.flatnonzero(adjacent[row] & open_rows)
            open_rows[new] = False
            left.append(np.full(len(new), row))
            right.append(new)
            waiting.extend(new)
    return np.concatenate(left), np.concatenate(right)


def proposed_pairs(least: Fraction, forest: bool) -> Callable:
    """Candidate pairs of every block, as a function over sorted rows of blocks."""
    floor = estimated_floor(float(least))

    def of_block(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        nodes = rows.column("node").to_numpy()
        labels = rows.column("label").to_numpy()
        order = np.argsort(nodes, kind="stable")
        nodes, labels = nodes[order], labels[order]
        rows = rows.take(pa.array(order))
        sketches = Sketches(
            rows.column("fields").to_pylist(),
            rows.column("n").to_numpy(),
            rows.column("bits").to_pylist(),
        )
        count = len(nodes)
        found_i, found_j = [], []
        adjacent = np.zeros((count, count) if forest else (0, 0), dtype=bool)
        for at in range(0, count, SLICE):
            i = np.repeat(np.arange(at, min(at + SLICE, count)), count)
            j = np.tile(np.arange(count), min(SLICE, count - at))
            ahead = (j > i) & (labels[i] != labels[j])
            i, j = i[ahead], j[ahead]
            keep = sketches.may_link(i, j, least, floor)
            if forest:  # a bit for a pair; a block of copies has half a million of them
                adjacent[i[keep], j[keep]] = adjacent[j[keep], i[keep]] = True
            else:
                found_i.append(i[keep].astype(np.int16))
                found_j.append(j[keep].astype(np.int16))
        i, j = _forest(adjacent) if forest else (np.concatenate(found_i), np.concatenate(found_j))
        return nodes[i], nodes[j]

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def answer(pairs: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            a = np.concatenate([np.empty(0, np.int64), *(pair[0] for pair in pairs)])
            b = np.concatenate([np.empty(0, np.int64), *(pair[1] for pair in pairs)])
            return pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"]
            )

        rest: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if rest is not None:
                rows = pa.concat_tables([rest, rows])
            starts = _block_starts(rows)
            pairs = [
                of_block(rows.slice(a, b - a)) for a, b in zip(starts[:-1], starts[1:], strict=True)
            ]
            rest = rows.slice(starts[-1])
            if pairs:
                yield answer(pairs)
        if rest is not None and len(rest):
            yield answer([of_block(rest)])

    return propose


def _block_starts(rows: pa.Table) -> np.ndarray:
    keys = [rows.column(name).to_numpy() for name in ("key", "block_a", "block_b")]
    changes = np.zeros(max(0, len(rows) - 1), dtype=bool)
    for values in keys:
        changes |= values[1:] != values[:-1]
    return np.concatenate(([0], np.flatnonzero(changes) + 1)).astype(np.int64)


def digests(rows: DataFrame, words: int, key: str, text: str) -> DataFrame:
    """id, number of shingles, fingerprint of the set, packed fields and band keys."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for batch in batches for part in slices(batch, 1)):
            sets = shingle_sets(batch.column(1).to_pylist(), words)
            values = [minima(found) if len(found) else None for found in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(found) for found in sets], pa.int64()),
                    pa.array(
                        [hashlib.blake2b(found.tobytes(), digest_size=16).digest() for found in sets],
                        pa.binary(),
                    ),
                    pa.array(
                        [None if v is None else packed_fields(v) for v in values], pa.binary()
                    ),
                    pa.array(
                        [None if v is None else band_keys(v) for v in values],
                        pa.list_(pa.int64()),
                    ),
                ],
                ["id", "n", "set_key", "fields", "bands"],
            )

    picked = rows.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string"))
    return picked.mapInArrow(
        digest, "id long, n long, set_key binary, fields binary, bands array<long>"
    )


def whole_sets(rows: DataFrame, nodes: DataFrame, words: int, key: str, text: str) -> DataFrame:
    """node, shingles and bitmap of the candidates, of which nodes has id, set_key and node."""

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for batch in batches for part in slices(batch, 1)):
            sets = shingle_sets(batch.column(1).to_pylist(), words)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(
                        [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets],
                        pa.binary(),
                    ),
                    pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                    pa.array([bitmap(s) if len(s) else b"" for s in sets], pa.binary()),
                ],
                ["id", "set_key", "shingles", "bits"],
            )

    picked = rows.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    # most texts are candidates of nothing, and stay where they are
    by_id = F.xxhash64("id")
    picked = perhaps_among(picked, by_id, nodes, by_id)
    made = picked.join(nodes.select("id").distinct(), "id", "left_semi").mapInArrow(
        sets_of, "id long, set_key binary, shingles array<long>, bits binary"
    )
    # other rows with the id of a class don't speak for it; a class is named by its smallest id,
    # so rows that are equal in both are of one class, and the join has put them together
    of_class = made.join(nodes.select("id", "set_key", "node"), ["id", "set_key"])
    return of_class.dropDuplicates(["id", "set_key"]).select("node", "shingles", "bits")


def _links_of_ids(compared: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes that hold rows of one id."""
    print_of = F.xxhash64("set_key")
    several = (
        compared.groupBy("id")
        .agg(F.min(print_of).alias("low"), F.max(print_of).alias("high"))
        .where("low <> high")
        .select("id")
    )
    members = stored(
        compared.select("id", "set_key")
        .join(several, "id", "left_semi")
        .distinct()
        .join(classes.select("set_key", "node"), "set_key")
        .select("id", "node"),
        "ids",
    )
    least = members.groupBy("id").agg(F.min("node").alias("a"))
    return members.join(least, "id").where("a <> node").select("a", F.col("node").alias("b"))


def _confirmed(pairs: DataFrame, sets: DataFrame, least: Fraction) -> DataFrame:
    """Pairs whose whole sets are similar enough."""
    shingles = sets.select("node", "shingles")
    left = shingles.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    right = shingles.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    joined = pairs.distinct().join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("set_a", "set_b")).cast("long")
    union = F.size("set_a") + F.size("set_b") - F.col("shared")
    return (
        joined.withColumn("shared", shared)
        .where(F.col("shared") * least.denominator >= union * least.numerator)
        .select("a", "b")
    )


def _in_blocks(members: DataFrame) -> DataFrame:
    """Members with the pairs of blocks they take part in; a small bucket is one block."""
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("node"), blocks).cast("int")
    spread = members.withColumn("block", block).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1))
    )
    # the pair of a block with itself is done along with the pairs of different blocks
    alone = (F.col("size") <= BLOCK) | (F.col("block") != F.col("other"))
    return spread.where(alone).select(
        "*",
        F.least("block", "other").alias("block_a"),
        F.greatest("block", "other").alias("block_b"),
    )


def _propose(
    members: DataFrame, sketches: DataFrame, labels: DataFrame | None, least: Fraction
) -> DataFrame:
    label = F.col("node") if labels is None else F.coalesce(F.col("component"), F.col("node"))
    labelled = members if labels is None else members.join(labels, "node", "left")
    labelled = labelled.withColumn("label", label)
    if labels is not None:  # buckets of one component hold nothing new
        open_keys = (
            labelled.groupBy("key")
            .agg(F.min("label").alias("low"), F.max("label").alias("high"))
            .where("low <> high")
            .select("key")
        )
        labelled = labelled.join(open_keys, "key", "left_semi")
    rows = _in_blocks(labelled.select("key", "size", "node", "label")).join(sketches, "node")
    keys = ["key", "block_a", "block_b"]
    return (
        rows.select(*keys, "node", "label", "n", "fields", "bits")
        .repartition(*keys)
        .sortWithinPartitions(*keys)
        .mapInArrow(proposed_pairs(least, labels is None), "a long, b long")
    )


def near_duplicates(
    rows: DataFrame,
    words: int = 5,
    similarity: str = "0.8",
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row.

    Rows are linked if the Jaccard similarity of their shingle sets reaches similarity, a
    decimal number as text. component_id is the smallest id reachable over links, and kept
    marks the row that has it. A pair just at 0.8 is missed by all bands with a chance of
    5e-8, at 0.85 of 6e-11; every other step is exact.
    """
    least = Fraction(similarity)
    digest = stored(digests(rows, words, key, text), "digests")
    compared = digest.where("id is not null and n > 0")
    classes = stored(
        compared.groupBy("set_key")
        .agg(
            F.min("id").alias("id"),
            F.first("n").alias("n"),
            F.first("fields").alias("fields"),
            F.first("bands").alias("bands"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    keyed = classes.select("node", F.explode("bands").alias("key"))
    fingerprint = F.xxhash64("node")
    buckets = (
        keyed.groupBy("key")
        .agg(
            F.count("*").alias("size"),
            F.sum(F.shiftright(fingerprint, 24)).alias("total"),
            F.bit_xor(fingerprint).alias("mixed"),
        )
        .where("size > 1")
        .groupBy("size", "total", "mixed")  # the same members need comparing once
        .agg(F.min("key").alias("key"))
        .select("key", "size")
    )
    members = stored(keyed.join(buckets, "key"), "members")
    nodes = members.select("node").distinct()
    candidates = stored(
        classes.join(nodes, "node", "left_semi").select("id", "set_key", "node", "n", "fields"), "candidates"
    )
    sets = stored(whole_sets(rows, candidates, words, key, text), "sets")
    sketches = candidates.select("node", "n", "fields").join(sets.select("node", "bits"), "node")
    similar = _confirmed(_propose(members, sketches, None, least), sets, least)
    first = stored(similar.unionByName(_links_of_ids(compared, classes)), "links")
    merged = components(first)
    rest = _confirmed(_propose(members, sketches, merged, least), sets, least)
    links = stored(first.unionByName(rest), "links")
    discard(merged)
    final = components(links)
    ids = stored(final.join(classes.select("node", "id"), "node"), "joined")
    smallest = ids.groupBy("component").agg(F.min("id").alias("smallest"))
    joined = ids.join(smallest, "component").select("node", "smallest")
    labels = stored(
        classes.select("set_key", "node", "id").join(joined, "node", "left").select(
            "set_key", F.coalesce("smallest", "id").alias("component")
        ),
        "labels",
    )
    discard(classes, members, candidates, sets, first, links, ids, final)
    return _with_components(digest, labels, key)


def _with_components(digest: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    component = F.when(F.col("id").isNotNull(), F.coalesce(F.col("component"), F.col("id")))
    kept: Column = F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))
    rows = digest.select("id", "n", F.when(F.col("n") > 0, F.col("set_key")).alias("set_key"))
    empty = F.coalesce(F.col("n") == 0, F.lit(False))
    # a row without shingles goes where the other rows of its id are
    bare = rows.where(empty & F.col("id").isNotNull()).select("id").distinct()
    of_id = (
        rows.where(~empty)
        .join(bare, "id", "left_semi")
        .join(labels, "set_key")
        .groupBy("id")
        .agg(F.min("component").alias("component"))
    )
    whole = rows.where(~empty).join(labels, "set_key", "left").select("id", "n", "component")
    rest = rows.where(empty).join(of_id, "id", "left").select("id", "n", "component")
    return (
        whole.unionByName(rest)
        .withColumn("component_id", component)
        .select(
            F.col("id").alias(key), F.col("n").alias("n_shingles"), "component_id", kept.alias("kept")
        )
    )


def without_copies(
    rows: DataFrame,
    words: int = 5,
    similarity: str = "0.8",
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The rows, whole, of which one stays of every near-duplicate group.

    The row with the group's smallest id stays; of several with that id, the one with the
    smallest hash. Rows of one id are in one group, so the id alone tells whether they stay.
    Rows with a null id all stay. What stays without a choice is not moved.
    """
    marked = near_duplicates(rows, words, similarity, key, text).where(F.col(key).isNotNull())
    counted = marked.groupBy(key).agg(F.bool_and("kept").alias("kept"), F.count("*").alias("copies"))
    chosen = stored(counted.where("NOT kept OR copies > 1"), "chosen")
    by_id = F.xxhash64(F.col(key).cast("long"))
    apart, others = surely_apart(rows, by_id, chosen, by_id)
    kept = apart.unionByName(others.join(chosen.select(key), key, "left_anti"))
    repeated = chosen.where("kept").select(key)
    if repeated.isEmpty():
        return kept.select(rows.columns)
    whole = F.struct(*[F.col(name) for name in rows.columns])
    one = (
        others.join(repeated, key, "left_semi")
        .groupBy(F.col(key).alias("group"))
        .agg(F.min_by(whole, F.xxhash64(whole)).alias("row"))
        .select("row.*")
    )
    return kept.select(rows.columns).unionByName(one)
