"""Quality rules on words and lines: what a text holds, and how often its lines occur elsewhere.

Lines are normalised (A-Z in lower case, runs of digits as one 0, white space between words as
one space) and hashed. A line is counted once in each distinct document of its host. A line in
more documents than the limit is boilerplate and is removed; a document is rejected when it
fails the base rules, or when what the removal leaves of it is too little.

Documents with equal texts on one host are one document here, so copies of a text, which other
operators find, do not make its lines boilerplate.

Edge cases: null text counts as empty: no words, and so it fails the base rules; null and empty
host are one host; rows with a null or repeated key are rows of their own, and equal rows get
equal results; a very long text is worked on alone and whole, some 60 bytes of memory for each
of its bytes; nothing is ranked, so ties do not arise; an empty table gives an empty result;
other columns are not read. A line's hash has 64 bits: two lines of one host that share it would
count as one line.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from hitledger.llm.tables import stored, text_or_empty
from hitledger.llm.words import SPACES, chunks, mix, range_hashes, run_hashes, separators_of, slices, split_words, windows

#: A line is boilerplate above this many documents of its host,
MAX_DOCUMENTS = 20
#: and above one in so many of the host's documents.
ONE_IN = 1000
#: Words below which a document fails, before and after lines are removed.
MIN_WORDS = 50
#: A document fails when more than this share of its words, in percent, is in repeated windows,
MAX_REPEATED = 50
#: or was removed with its lines.
MAX_REMOVED = 50
#: Words of a window that must not repeat.
WINDOW = 3
#: Frequent lines up to this number are sent to all executors (about 100 bytes each), more are
#: joined by shuffle.
BROADCAST_LINES = 100_000

SYMBOLS = separators_of(b"#*$%&|<>")
_DIGITS = re.compile(rb"[0-9]+")
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of the values of every range."""
    sums = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[ends] - sums[starts]


def _line_ranges(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, start and end of every line in a buffer of texts with one byte between them."""
    buffer = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    ends = np.flatnonzero(buffer == 10)
    starts = np.concatenate(([0], ends[:-1] + 1))
    sizes = np.fromiter((len(text) + 1 for text in texts), dtype=np.int64, count=len(texts))
    return np.searchsorted(np.cumsum(sizes), starts, side="right"), starts, ends


def _repeated_words(hashes: np.ndarray, owner: np.ndarray, size: int, texts: int) -> np.ndarray:
    """Words of every text that lie in a window found twice or more in that text."""
    found = windows(hashes, size)
    at = np.flatnonzero(owner[: len(found)] == owner[size - 1 :]) if len(found) else np.empty(0, int)
    _, which, times = np.unique(
        mix(found[at] ^ mix(owner[at].astype(np.uint64))), return_inverse=True, return_counts=True
    )
    covered = np.zeros(len(hashes) + size, dtype=bool)
    for k in range(size):
        covered[at[times[which] > 1] + k] = True
    return np.bincount(owner[covered[: len(hashes)]], minlength=texts)


def measures(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A row of BASE for every text; text, hash and words of each of its distinct lines."""
    words = split_words(texts, SPACES, lower=False)
    buffer, first, last = words.buffer, words.offsets[:-1], words.offsets[1:]
    n_words = last - first
    owner = np.repeat(np.arange(len(texts)), n_words)
    sizes = np.fromiter((len(text) + 1 for text in texts), dtype=np.int64, count=len(texts))
    begin = np.cumsum(sizes) - sizes
    letters = _sums((buffer & 0xC0) != 0x80, words.starts, words.ends)  # one for each code point
    of_line, starts, ends = _line_ranges(texts)
    in_line = np.searchsorted(words.starts, ends) - np.searchsorted(words.starts, starts)
    full = in_line > 0
    exact = mix(range_hashes(buffer, starts[full], ends[full]) ^ mix(of_line[full].astype(np.uint64)))
    _, at = np.unique(exact, return_index=True)
    lines = np.bincount(of_line[full], minlength=len(texts))
    base = np.stack(
        [
            n_words,
            _sums(letters, first, last),
            _sums(SYMBOLS[buffer], begin, begin + sizes),
            lines - np.bincount(of_line[full][at], minlength=len(texts)),
            _repeated_words(words.hashes, owner, WINDOW, len(texts)),
        ],
        axis=1,
    )
    # the same words in normal form: neither step joins, parts, adds or drops one
    plain = split_words([_DIGITS.sub(b"0", text) for text in texts], SPACES)
    stop = np.cumsum(in_line)
    normal = run_hashes(plain.hashes, (stop - in_line)[full], stop[full])
    keys = np.stack([of_line[full].astype(np.uint64), normal], axis=1)
    distinct, which = np.unique(keys, axis=0, return_inverse=True)
    counts = np.bincount(which.ravel(), weights=in_line[full], minlength=len(distinct))
    return base, distinct[:, 0].astype(np.int64), distinct[:, 1].view(np.int64), counts.astype(np.int64)


def _measured(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = [value.encode("utf-8", "surrogatepass") for value in batch.column(3).to_pylist()]
    bases, hashes, counts = [np.empty((0, len(BASE)), np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    lengths = [np.empty(0, np.int64)]
    for run in chunks([len(text) for text in texts]):
        base, owner, found, words = measures(texts[run.start : run.stop])
        bases.append(base)
        hashes.append(found)
        counts.append(words)
        lengths.append(np.bincount(owner, minlength=len(run)))
    offsets = pa.array(np.concatenate(([0], np.cumsum(np.concatenate(lengths)))).astype(np.int32))
    base = np.concatenate(bases)
    return pa.RecordBatch.from_arrays(
        [
            *batch.columns[:3],
            *(pa.array(np.ascontiguousarray(base[:, i])) for i in range(len(BASE))),
            pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(hashes))),
            pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(counts))),
        ],
        ["key", "host", "text_key", *BASE, "line", "line_words"],
    )


def measured(rows: DataFrame, key: str, text: str, host: str | None) -> DataFrame:
    """Every row's key, host, hash of the text, BASE, and hash and words of its distinct lines."""
    value = text_or_empty(F.col(text))
    picked = rows.select(
        F.col(key).alias("key"),
        (text_or_empty(F.col(host)) if host else F.lit("")).alias("host"),
        F.xxhash64(value).alias("text_key"),
        value.alias("text"),
    )

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 3):
                yield _measured(part)

    kind = picked.schema["key"].dataType.simpleString()
    base = ", ".join(f"{name} long" for name in BASE)
    schema = f"key {kind}, host string, text_key long, {base}, line array<long>, line_words array<long>"
    return picked.mapInArrow(take, schema)


def frequent_lines(lines: DataFrame, hosts: DataFrame, max_documents: int, one_in: int) -> DataFrame:
    """host and line of lines above both limits; lines: host, line, text_key; hosts: host, documents."""
    counted = lines.groupBy("host", "line").agg(F.count_distinct("text_key").alias("in_documents"))
    return (
        counted.where(F.col("in_documents") > max_documents)
        .join(hosts, "host")
        .where(F.col("in_documents") * one_in > F.col("documents"))
        .select("host", "line", "in_documents")
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def judged(digest: DataFrame, max_documents: int, one_in: int, with_lines: bool = False) -> DataFrame:
    """The digest with n_removed, base_failed and kept, and on demand the removed lines' hashes.

    From the digest on a line is a few numbers. Lines are counted with partial counts before
    each shuffle, so a line in a third of all documents costs a task no more than another.
    Frequent lines meet the documents' lines by a broadcast of a checked size, or else by a
    shuffle that adaptive execution divides where a line is hot.
    """
    each = F.explode(F.arrays_zip("line", "line_words"))
    lines = digest.select("row", "host", "text_key", each.alias("l")).select(
        "row", "host", "text_key", "l.line", "l.line_words"
    )
    hosts = digest.groupBy("host").agg(F.count_distinct("text_key").alias("documents"))
    frequent = stored(frequent_lines(lines, hosts, max_documents, one_in), "frequent").select("host", "line")
    few = frequent.count() <= BROADCAST_LINES
    hit = lines.drop("text_key").join(F.broadcast(frequent) if few else frequent, ["host", "line"])
    # no more of them than the document has lines
    gone = [F.collect_list("line").alias("gone")] if with_lines else []
    removed = hit.groupBy("row").agg(F.sum("line_words").alias("removed"), *gone)
    n_removed = F.coalesce("removed", F.lit(0).cast("long"))
    left = F.col("n_words") - F.col("n_removed")
    depleted = (left < MIN_WORDS) | (100 * F.col("n_removed") > MAX_REMOVED * F.col("n_words"))
    return (
        digest.drop("line", "line_words")
        .join(removed, "row", "left")
        .withColumns({"n_removed": n_removed, "base_failed": base_failed()})
        .withColumn("kept", ~F.col("base_failed") & ~depleted)
    )


def check_lines(
    rows: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    host: str | None = "source",
    max_documents: int = MAX_DOCUMENTS,
    one_in: int = ONE_IN,
) -> DataFrame:
    """Key, BASE, n_removed (words in frequent lines), base_failed, and kept for every row."""
    numbered = measured(rows, key, text, host).select(F.monotonically_increasing_id().alias("row"), "*")
    found = judged(stored(numbered, "lines"), max_documents, one_in)
    return found.select(F.col("key").alias(key), *BASE, "n_removed", "base_failed", "kept")


def _without(text: str, gone: set[int]) -> str:
    lines = text.split("\n")
    encoded = [line.encode("utf-8", "surrogatepass") for line in lines]
    _, owner, hashes, _ = measures(encoded)  # each line as a text of its own
    drop = {int(i) for i, found in zip(owner, hashes, strict=True) if int(found) in gone}
    return "\n".join(line for i, line in enumerate(lines) if i not in drop)


def without_boilerplate(
    rows: DataFrame,
    text: str = "text",
    host: str | None = "source",
    max_documents: int = MAX_DOCUMENTS,
    one_in: int = ONE_IN,
) -> DataFrame:
    """The rows that are kept, with frequent lines cut out of the text; columns stay as they are."""

    @F.pandas_udf("string")
    def cut(texts: pd.Series, gone: pd.Series) -> pd.Series:
        pairs = zip(texts, gone, strict=True)
        return pd.Series([_without(value, set(found.tolist())) for value, found in pairs], dtype=object)

    whole = rows.select(F.monotonically_increasing_id().alias("row"), F.struct(*rows.columns).alias("it"))
    numbered = stored(whole, "rows")
    content = numbered.select(
        "row",
        F.col("it").getField(text).alias("text"),
        (F.col("it").getField(host) if host else F.lit("")).alias("host"),
    )
    digest = stored(measured(content, "row", "text", "host").withColumnRenamed("key", "row"), "lines")
    verdicts = judged(digest, max_documents, one_in, with_lines=True).where("kept").select("row", "gone")
    kept = numbered.join(verdicts, "row")
    value = text_or_empty(F.col("it").getField(text))
    untouched = kept.where("gone IS NULL").select("it.*")
    changed = kept.where("gone IS NOT NULL").select(
        *(F.col("it").getField(name).alias(name) for name in rows.columns if name != text),
        cut(value, "gone").alias(text),
    )
    return untouched.unionByName(changed.select(rows.columns))
