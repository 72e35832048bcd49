"""Token counts of the sections of texts, from one encoding of every whole text.

A whole text is encoded once. The characters at which its tokens begin and end are joined
with the characters at which its sections begin and end; both are sorted, so the interval
join is a merge. A token may cross a border between sections, and tokenizers often join a
line's end with the next line's start, so sections encoded alone would count otherwise. The
rule for such a token is explicit: it counts where it begins, where it ends, or for each
section by its share of the token's characters.

Sections are the parts of a text between separators; a separator belongs to the section it
ends. They cover the whole text, so the counts of a text's sections add up to its tokens.
Fields are columns of a row; the document is their texts in the order given, with a separator
behind each but the last, and a separator belongs to the field it ends.

Edge cases: a null field counts as an empty one, and so does one that is not text and null; a
very long text is encoded whole, which takes some 100 bytes for each of its characters;
sections are in the order of the text, so ties do not arise; text that is null or empty has one
section, empty, without tokens; a token that holds part of a character counts for the section
of that character; equal rows are counted alike and all kept; an empty table gives an empty
result; columns other than key and text are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

START, END, SHARE = "start", "end", "share"
RULES = (START, END, SHARE)


class Tokenizer:
    """Byte-level merges from a rank file, with the bytes of every token."""

    def __init__(self, rank_file: str, pattern: str) -> None:
        import tiktoken

        with open(rank_file, "rb") as file:
            ranks = {
                base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)
            }
        self.encoding = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self.lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """First character of each token, and the one behind its last, in characters.

        A character that is split among tokens belongs to all of them.
        """
        ids = np.array(self.encoding.encode_ordinary(text), dtype=np.int64)
        ends = np.cumsum(self.lengths[ids])
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        if len(raw) == len(text):
            return ends - self.lengths[ids], ends
        begun = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
        starts = ends - self.lengths[ids]
        # the character a byte is part of is the last one begun at or before it
        return begun[starts + 1] - 1, begun[ends]


_tokenizers: dict[tuple[str, str], Tokenizer] = {}


def tokenizer_of(rank_file: str, pattern: str) -> Tokenizer:
    """The tokenizer of a rank file, made once by each worker process."""
    name = (rank_file, pattern)
    if name not in _tokenizers:
        _tokenizers[name] = Tokenizer(rank_file, pattern)
    return _tokenizers[name]


def section_ends(text: str, separator: str) -> np.ndarray:
    """Character behind each section's last one, separators included."""
    ends, at = [], 0
    while (found := text.find(separator, at)) >= 0:
        at = found + len(separator)
        ends.append(at)
    if at < len(text) or not text:
        ends.append(len(text))
    return np.array(ends, dtype=np.int64)


def allocate(starts: np.ndarray, ends: np.ndarray, borders: np.ndarray, rule: str) -> np.ndarray:
    """Tokens of every section; borders are the sections' ends.

    Under SHARE a token counts for a section by the part of its characters that is inside.
    """
    first = np.searchsorted(borders, starts, side="right")
    last = np.searchsorted(borders, ends - 1, side="right")
    if rule != SHARE:
        where = first if rule == START else last
        return np.bincount(where, minlength=len(borders)).astype(float)
    counts = np.bincount(first[first == last], minlength=len(borders)).astype(float)
    lows = np.concatenate(([0], borders[:-1]))
    for k in np.flatnonzero(first != last):
        inside = slice(first[k], last[k] + 1)
        part = np.minimum(ends[k], borders[inside]) - np.maximum(starts[k], lows[inside])
        counts[inside] += part / (ends[k] - starts[k])
    return counts


def count_section_tokens(
    rows: DataFrame,
    rank_file: str,
    pattern: str,
    rule: str = START,
    separator: str = "\n",
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Key, section from 0, its first character and length, and its n_tokens.

    rank_file is a path that every executor can open. One row leaves a worker for each
    section, none for a token.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {', '.join(RULES)}")
    if not separator:
        raise ValueError("separator must not be empty")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_of(rank_file, pattern)
        for batch in batches:
            borders, counts = [], []
            for value in batch.column(1):
                content = value.as_py() or ""
                ends = section_ends(content, separator)
                a, b = tokenizer.spans(content)
                borders.append(ends)
                counts.append(allocate(a, b, ends, rule))
            sizes = np.fromiter(map(len, borders), dtype=np.int64, count=len(borders))
            owner = np.repeat(np.arange(len(borders)), sizes)
            ends = np.concatenate(borders) if borders else np.empty(0, np.int64)
            section = np.arange(len(ends)) - (np.cumsum(sizes) - sizes)[owner]
            starts = np.where(section == 0, 0, np.concatenate(([0], ends[:-1])))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(owner)),
                    pa.array(section.astype(np.int32)),
                    pa.array(starts),
                    pa.array(ends - starts),
                    pa.array(np.concatenate(counts) if counts else np.empty(0)),
                ],
                ["key", "section", "first_char", "n_chars", "n_tokens"],
            )

    picked = rows.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = picked.schema["key"].dataType.simpleString()
    schema = f"key {kind}, section int, first_char long, n_chars long, n_tokens double"
    return picked.mapInArrow(count, schema).withColumnRenamed("key", key)


def count_field_tokens(
    rows: DataFrame,
    fields: Sequence[str],
    rank_file: str,
    pattern: str,
    rule: str = START,
    separator: str = "\n",
    key: str = "doc_id",
) -> DataFrame:
    """Key, field, its first character in the document and length, and its n_tokens.

    The document of a row, its fields with separators between them, is encoded once, so the
    counts of a row's fields add up to the tokens of the document as a model would see it.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {', '.join(RULES)}")
    if not fields or len(set(fields)) < len(fields):
        raise ValueError("fields must be names of different columns")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_of(rank_file, pattern)
        for batch in batches:
            starts, sizes, counts = [], [], []
            for texts in zip(*(column.to_pylist() for column in batch.columns[1:]), strict=True):
                parts = [(text or "") + separator for text in texts[:-1]] + [texts[-1] or ""]
                ends = np.cumsum([len(part) for part in parts])
                first, behind = tokenizer.spans("".join(parts))
                starts.append(np.concatenate(([0], ends[:-1])))
                sizes.append(np.diff(ends, prepend=0))
                counts.append(_of_parts(first, behind, ends, rule))
            owner = np.repeat(np.arange(len(batch)), len(fields))
            none = [np.empty(0)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(owner)),
                    pa.array(list(fields) * len(batch), pa.string()),
                    pa.array(np.concatenate(none + starts).astype(np.int64)),
                    pa.array(np.concatenate(none + sizes).astype(np.int64)),
                    pa.array(np.concatenate(none + counts)),
                ],
                ["key", "field", "first_char", "n_chars", "n_tokens"],
            )

    texts = [F.col(name).cast("string").alias(f"f{i}") for i, name in enumerate(fields)]
    picked = rows.select(F.col(key).alias("key"), *texts)
    kind = picked.schema["key"].dataType.simpleString()
    schema = f"key {kind}, field string, first_char long, n_chars long, n_tokens double"
    return picked.mapInArrow(count, schema).withColumnRenamed("key", key)


def _of_parts(starts: np.ndarray, ends: np.ndarray, borders: np.ndarray, rule: str) -> np.ndarray:
    """As ``allocate``, where parts may be empty: these have no tokens."""
    full = np.flatnonzero(np.diff(borders, prepend=0))
    counts = np.zeros(len(borders))
    if len(full):
        counts[full] = allocate(starts, ends, borders[full], rule)
    return counts
