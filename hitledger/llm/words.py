"""Words of many texts at once, as numpy arrays over one byte buffer.

A word's hash is a polynomial in its bytes modulo 2**64, taken from running sums, then
mixed. Work per byte is a handful of vector operations and no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Odd multiplier of the byte polynomial; any odd number works, all tasks need the same one.
BASE = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1
#: Bytes of text that are worked on together; a longer text is worked on alone.
CHUNK_BYTES = 1 << 18
#: Bytes of text of the rows that a worker takes out of a batch at once.
SLICE_BYTES = 4 << 20

_powers: dict[str, np.ndarray] = {}


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i below size."""
    if "up" not in _powers or len(_powers["up"]) < size:
        size = max(size, CHUNK_BYTES + 1024)
        for name, factor in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            table = np.full(size, np.uint64(factor))
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"], _powers["down"]


def mix(values: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over all 64 bits."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """Words of several texts: hash, byte range in the buffer, and where each text begins.

    Words of text i are those from offsets[i] to offsets[i + 1].
    """

    buffer: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    offsets: np.ndarray


def range_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of every byte range of a buffer; equal bytes give equal hashes."""
    up, down = _power_tables(len(buffer) + 1)
    # +1 so that zero bytes count too
    sums = np.empty(len(buffer) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum((buffer.astype(np.uint64) + np.uint64(1)) * up[: len(buffer)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of every run of neighbouring hashes; equal sequences give equal hashes."""
    up, down = _power_tables(len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def split_words(texts: list[bytes], separators: np.ndarray, lower: bool = True) -> Words:
    """Maximal runs of bytes that are no separators.

    separators: 256 booleans, by byte; byte 0x20 must be one of them.
    """
    joined = b" ".join(texts) + b" "
    buffer = np.frombuffer(joined.lower() if lower else joined, dtype=np.uint8)
    inside = np.zeros(len(buffer) + 1, dtype=np.int8)
    inside[1:] = ~separators[buffer]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[0::2], edges[1::2]
    lengths = np.fromiter((len(text) + 1 for text in texts), dtype=np.int64, count=len(texts))
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    return Words(
        buffer,
        starts,
        ends,
        range_hashes(buffer, starts, ends),
        np.searchsorted(starts, bounds),
    )


def separators_of(characters: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(characters)] = True
    return table


#: White space of the ASCII range: space and the bytes 9 to 13.
SPACES = separators_of(b" \t\n\x0b\x0c\r")
#: All ASCII bytes but letters and digits; bytes of other characters belong to words.
NOT_ALNUM = ~np.array([i >= 128 or chr(i).isalnum() for i in range(256)])


def chunks(sizes: list[int], limit: int = CHUNK_BYTES) -> Iterator[range]:
    """Runs of neighbouring texts of at most limit bytes together, or one longer text."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield range(start, i)
            start, total = i, 0
        total += size + 1
    if start < len(sizes):
        yield range(start, len(sizes))


def slices(batch: pa.RecordBatch, text: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most limit bytes in a text column, or with one longer text.

    A batch may hold far more text than a worker should have as Python objects at once. An
    empty batch gives itself.
    """
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
    if not sizes:
        yield batch
    for run in chunks(sizes, limit):
        yield batch.slice(run.start, len(run))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of size neighbouring hashes; entry i covers i to i + size - 1."""
    if len(hashes) < size:
        return np.empty(0, dtype=np.uint64)
    count = len(hashes) - size + 1
    total = np.zeros(count, dtype=np.uint64)
    for k in range(size):
        total *= np.uint64(BASE)
        total += hashes[k : k + count]
    return mix(total)
