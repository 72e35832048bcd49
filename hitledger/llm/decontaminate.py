"""Benchmark decontamination by templates, which also catches re-parameterised questions.

Numbers, units behind numbers, and names become typed placeholders, runs of one type a single
one; what is left are lower-cased words. Windows of the resulting template are hash-joined
with the windows of the benchmark. A joined window counts if its slots are consistent: equal
values on one side stand against equal values on the other, so a question asked again with
other numbers and names is found, and an unrelated text of the same shape is not.

What a window's first word is taken for hangs on what stands before it, so windows of the
benchmark are sought in every reading of it, and in a text a window may begin with the last word
of a placeholder. A template window needs a share of literal words. Exact copies need none:
windows of the plain lower-cased words are joined as well. Before the join, windows pass a
bitmap of the benchmark's hashes; its size is fixed, so a larger benchmark only lets more
windows through to the join, which is exact.

Edge cases: a very long text is worked on alone and whole, some 80 bytes for each of its bytes;
each pair of text and item is one finding, so ties do not arise; null or empty text, or one
shorter than every window, has no findings; benchmark rows with null id or text are not sought,
nor those of fewer than FEWEST words, which not_sought counts; an item shorter than a window is
sought as a whole, one of fewer than SHORTEST template tokens word by word only; repeated rows
are found alike, one finding for each key, text and item; a null key is carried along; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hitledger.llm.tables import stored, surely_apart
from hitledger.llm.words import NOT_ALNUM, chunks, separators_of, slices, split_words, windows

#: Template tokens or words of a window, tokens of the shortest item whose template is sought,
#: and words of the shortest item that is sought word by word.
WINDOW, SHORTEST, FEWEST = 12, 5, 3
#: Share of a window that must be words rather than placeholders.
LITERAL_SHARE = 0.5
#: Bits of the bitmap that windows pass before the join.
FILTER_BITS = 1 << 25

WORD, NUMBER, UNIT, NAME = range(4)
NUMBER_WORDS = (
    "two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty "
    "hundred thousand million billion dozen"
).split()
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram "
    "kilograms ounce ounces pound pounds ton tons ml l liter liters litre litres gallon gallons "
    "second seconds minute minutes hour hours day days week weeks month months year years "
    "degree degrees percent cent cents dollar dollars euro euros mph kmh"
).split()
_ENDERS = separators_of(b".!?:;\n\r")
#: Stand-ins for the placeholders' hashes; words never hash to such small numbers in practice.
_PLAIN = np.uint64(0x5851F42D4C957F2D)  # tells windows of words from those of templates
_PLACEHOLDERS = np.array([0, 11, 22, 33], dtype=np.uint64)


def _hashes_of(words: list[str]) -> np.ndarray:
    return np.sort(split_words([" ".join(words).encode()], NOT_ALNUM).hashes)


_NUMBER_HASHES, _UNIT_HASHES = _hashes_of(NUMBER_WORDS), _hashes_of(UNITS)


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    at = np.searchsorted(known, values)
    at[at == len(known)] = 0
    return known[at] == values


@dataclass
class Templates:
    """Template tokens of several texts: hash, type, owner, byte range, start of the last word.

    word_hashes and word_owner are those of the words that the tokens are made of.
    """

    raw: bytes
    hashes: np.ndarray
    kinds: np.ndarray
    owner: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    last_starts: np.ndarray
    word_hashes: np.ndarray
    word_owner: np.ndarray

    def slots(self, first: int, size: int, last_word: bool = False) -> list[str]:
        """Type and text of the placeholders of a window; of the first only its last word, if asked."""
        starts = self.starts[first : first + size].copy()
        if last_word:
            starts[0] = self.last_starts[first]
        return [
            f"{self.kinds[i]}:{self.raw[start : self.ends[i]].decode('utf-8', 'replace')}"
            for i, start in zip(range(first, first + size), starts, strict=True)
            if self.kinds[i]
        ]


def templates(texts: list[bytes], behind_kind: int = WORD) -> Templates:
    """Tokens of texts that begin a sentence, or that a word or number stands before.

    behind_kind tells what a text's first word is taken for: WORD at a beginning, NAME inside a
    sentence, UNIT behind a number, each only if the word allows for it.
    """
    words = split_words(texts, NOT_ALNUM)
    raw = b" ".join(texts) + b" "
    buffer = np.frombuffer(raw, dtype=np.uint8)
    owner = np.repeat(np.arange(len(texts)), np.diff(words.offsets))
    starts, ends = words.starts, words.ends
    enders = np.concatenate(([0], np.cumsum(_ENDERS[buffer])))
    begins = np.ones(len(starts), dtype=bool)  # the first word of a text or sentence
    firsts = np.ones(len(starts), dtype=bool)
    firsts[1:] = owner[1:] != owner[:-1]
    begins[1:] = firsts[1:] | (enders[starts[1:]] > enders[ends[:-1]])
    if behind_kind != WORD:
        begins &= ~firsts
    head, second = buffer[starts], buffer[starts + 1]
    digit = (head >= 48) & (head <= 57)
    capital = (head >= 65) & (head <= 90) & ~((second >= 65) & (second <= 90))
    capital |= (head == 0xC3) & (second >= 0x80) & (second <= 0x9E)
    kinds = np.zeros(len(starts), dtype=np.int8)
    kinds[capital & ~begins] = NAME
    kinds[digit | _among(words.hashes, _NUMBER_HASHES)] = NUMBER
    behind = firsts & (behind_kind == UNIT)
    behind[1:] |= (kinds[:-1] == NUMBER) & (owner[1:] == owner[:-1])
    kinds[behind & (kinds != NUMBER) & _among(words.hashes, _UNIT_HASHES)] = UNIT
    joined = np.zeros(len(starts), dtype=bool)  # with the placeholder before it
    joined[1:] = (kinds[1:] > 0) & (kinds[1:] == kinds[:-1]) & (owner[1:] == owner[:-1])
    kept = np.flatnonzero(~joined)
    last = np.concatenate((kept[1:], [len(starts)])) - 1 if len(kept) else kept
    return Templates(
        raw.lower(),
        np.where(kinds[kept] > 0, _PLACEHOLDERS[kinds[kept]], words.hashes[kept]),
        kinds[kept],
        owner[kept],
        starts[kept],
        ends[last],
        starts[last],
        words.hashes,
        owner,
    )


def template_windows(found: Templates, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First token and hash of every window with enough words that lies in one text."""
    hashes = windows(found.hashes, size)
    if not len(hashes):
        return np.empty(0, np.int64), hashes
    words = np.concatenate(([0], np.cumsum(found.kinds == WORD)))
    literal = words[size:] - words[:-size] >= LITERAL_SHARE * size
    at = np.flatnonzero((found.owner[: len(hashes)] == found.owner[size - 1 :]) & literal)
    return at, hashes[at]


def word_windows(found: Templates, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Owner and hash of every window of plain words that lies in one text."""
    hashes = windows(found.word_hashes ^ _PLAIN, size)
    owner = found.word_owner
    at = np.flatnonzero(owner[: len(hashes)] == owner[size - 1 :]) if len(hashes) else np.empty(0, np.int64)
    return owner[at], hashes[at]


def _readings(raw: bytes, size: int) -> Iterator[tuple[int, np.uint64, list[str]]]:
    """Size, hash and slots of an item's windows whose first word can be read in another way."""
    found = templates([raw])
    count = len(found.hashes)
    heads = [0] if count <= size else list(range(count - size + 1))
    # two tokens more than a window, since another reading may join the first two
    pieces = [raw[found.starts[t] : found.ends[min(count, t + size + 2) - 1]] for t in heads]
    for kind in (WORD, NAME, UNIT):
        read = templates(pieces, kind)
        bounds = np.searchsorted(read.owner, np.arange(len(pieces) + 1))
        by_size: dict[int, list[int]] = {}
        for first, last in zip(bounds[:-1], bounds[1:], strict=True):
            width = min(WINDOW, int(last - first))
            # of a longer item, only whole windows
            if width >= SHORTEST and (count <= size or width == size):
                by_size.setdefault(width, []).append(int(first))
        for width, firsts in by_size.items():
            at, keys = template_windows(read, width)
            for k in np.flatnonzero(np.isin(at, firsts)):
                yield width, keys[k], read.slots(int(at[k]), width)


WINDOWS = "key {kind}, text_hash long, window long, plain boolean, slots array<string>"


def _encoded(texts: list[str | None]) -> list[bytes]:
    return [(text or "").encode("utf-8", "surrogatepass") for text in texts]


def benchmark_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """item, size, window, plain and slots of every window of every item.

    plain marks windows of words, which have no slots.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sizes, keys, plain, slots = [], [], [], [], []

            def add(i: int, size: int, key: np.uint64, words: bool, values: list[str]) -> None:
                for column, value in zip((rows, sizes, keys, plain, slots), (i, size, key, words, values)):
                    column.append(value)

            for i, raw in enumerate(_encoded(batch.column(1).to_pylist())):
                found = templates([raw])
                size = min(WINDOW, len(found.hashes))
                if size >= SHORTEST:
                    for first, key in zip(*template_windows(found, size), strict=True):
                        add(i, size, key, False, found.slots(first, size))
                if size:
                    for width, key, values in _readings(raw, size):
                        add(i, width, key, False, values)
                words = min(WINDOW, len(found.word_hashes))
                if words >= FEWEST:
                    for key in word_windows(found, words)[1]:
                        add(i, words, key, True, [])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(sizes, pa.int32()),
                    pa.array(np.array(keys, np.uint64).view(np.int64)),
                    pa.array(plain, pa.bool_()),
                    pa.array(slots, pa.list_(pa.string())),
                ],
                ["item", "size", "window", "plain", "slots"],
            )

    picked = benchmark.where(F.col(item).isNotNull() & F.col(text).isNotNull()).select(
        F.col(item).alias("item"), F.col(text).cast("string")
    )
    kind = picked.schema["item"].dataType.simpleString()
    return picked.mapInArrow(
        cut, f"item {kind}, size int, window long, plain boolean, slots array<string>"
    ).distinct()


def not_sought(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> int:
    """Benchmark rows that findings does not look for: no id or text, or fewer than FEWEST words."""
    words = F.size(F.regexp_extract_all(F.col(text).cast("string"), F.lit(r"[A-Za-z0-9\x{80}-\x{10FFFF}]+"), F.lit(0)))
    few = F.col(item).isNull() | F.col(text).isNull() | (words < FEWEST)
    return benchmark.where(few).count()


def _filter_of(sought: DataFrame) -> tuple[np.ndarray, list[tuple[bool, int]]]:
    """Bitmap of the sought windows and their kinds and sizes; neither grows with the benchmark."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column(0).to_numpy().view(np.uint64) % np.uint64(FILTER_BITS)
            # words of the bitmap, so that the answer is bounded however many windows there are
            unique = np.unique(places)
            words, first = np.unique(unique >> np.uint64(6), return_index=True)
            bits = np.bitwise_or.reduceat(np.uint64(1) << (unique & np.uint64(63)), first) if len(unique) else unique
            yield pa.RecordBatch.from_arrays(
                [pa.array(words.astype(np.int32)), pa.array(bits.view(np.int64))], ["word", "bits"]
            )

    marked = sought.select("window").mapInArrow(mark, "word int, bits long")
    rows = marked.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    bitmap = np.zeros(FILTER_BITS // 64, dtype=np.uint64)
    bitmap[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    kinds = sought.select("plain", "size").distinct().collect()  # two for a size below WINDOW + 1
    return bitmap, sorted((row["plain"], row["size"]) for row in kinds)


def findings(
    rows: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Key, text_hash, item, n_windows and exact for every row that holds part of an item.

    n_windows counts different template windows of the item in the text, or windows of words
    where no template was found; exact tells that one of them has the item's own numbers and
    names. text_hash is Spark's xxhash64 of the text, which
    tells rows apart that share a key.
    """
    sought = benchmark_windows(benchmark, item, item_text)
    bitmap, sizes = _filter_of(sought)
    shared = rows.sparkSession.sparkContext.broadcast(bitmap)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in (part for batch in batches for part in slices(batch, 2)):
            texts = _encoded(batch.column(2).to_pylist())
            at, keys, plain, slots = [], [], [], []

            def add(row: int, key: np.uint64, words: bool, values: list[str]) -> None:
                for column, value in zip((at, keys, plain, slots), (row, key, words, values)):
                    column.append(value)

            for run in chunks([len(text) for text in texts]):
                found = templates([texts[i] for i in run])
                for words, size in sizes:
                    first, hashes = (word_windows if words else template_windows)(found, size)
                    place = hashes % np.uint64(FILTER_BITS)
                    hit = (known[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1)
                    for k in np.flatnonzero(hit):
                        if words:
                            add(run.start + first[k], hashes[k], True, [])
                            continue
                        t = first[k]
                        row = run.start + found.owner[t]
                        add(row, hashes[k], False, found.slots(t, size))
                        if found.last_starts[t] > found.starts[t]:
                            add(row, hashes[k], False, found.slots(t, size, last_word=True))
            where = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(where),
                    batch.column(1).take(where),
                    pa.array(np.array(keys, np.uint64).view(np.int64)),
                    pa.array(plain, pa.bool_()),
                    pa.array(slots, pa.list_(pa.string())),
                ],
                ["key", "text_hash", "window", "plain", "slots"],
            )

    content = F.col(text).cast("string")
    picked = rows.where(content.isNotNull()).select(
        F.col(key).alias("key"), F.xxhash64(content).alias("text_hash"), content.alias("text")
    )
    kind = picked.schema["key"].dataType.simpleString()
    hits = picked.mapInArrow(cut, WINDOWS.format(kind=kind)).distinct()
    items = sought.select("item", "window", "plain", F.col("slots").alias("item_slots"))
    pairs = F.size(F.array_distinct(F.arrays_zip("slots", "item_slots")))
    consistent = (
        (F.size("slots") == F.size("item_slots"))
        & (pairs == F.size(F.array_distinct("slots")))
        & (pairs == F.size(F.array_distinct("item_slots")))
    )
    return (
        hits.join(items, ["window", "plain"])
        .where(consistent)
        .groupBy("key", "text_hash", "item")
        .agg(
            F.countDistinct(F.when(~F.col("plain"), F.col("window"))).alias("templates"),
            F.countDistinct(F.when(F.col("plain"), F.col("window"))).alias("passages"),
            F.bool_or(F.col("slots") == F.col("item_slots")).alias("exact"),
        )
        .withColumn("n_windows", F.coalesce(F.nullif(F.col("templates"), F.lit(0)), F.col("passages")))
        .select(F.col("key").alias(key), "text_hash", F.col("item").alias(item), "n_windows", "exact")
    )


def without_findings(
    rows: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows, whole, in which nothing was found; most of them are not moved."""
    marks = found.select(F.col(key).alias("__key"), F.col("text_hash").alias("__hash")).distinct()
    marks = stored(marks, "marks")
    content = F.xxhash64(F.col(text).cast("string"))
    same = F.col(key).eqNullSafe(F.col("__key")) & (content == F.col("__hash"))
    apart, others = surely_apart(rows, content, marks, F.col("__hash"))
    return apart.unionByName(others.join(marks, same, "left_anti"))
