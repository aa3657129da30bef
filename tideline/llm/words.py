"""Words and word shingles of Arrow text columns as 64-bit hashes, whole batches at a time.

A word is a run of bytes outside ``\\x20 \\x09-\\x0D`` with A-Z lower-cased. Null texts count as
empty. Two different shingles share a hash with probability 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MULTIPLIERS = (np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_PLACES = (np.random.default_rng(8).integers(1, 2**63, 64, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 output bits (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: Rows of a batch that a Python worker holds at once; Spark's own limit in bytes holds besides.
BATCH_ROWS = 250


def small_batches(spark: SparkSession) -> None:
    """Have the session hand texts to Python workers in small batches, unless its batches are smaller."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = int(spark.conf.get(name, "10000"))
    if rows <= 0 or rows > BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and the offsets of its rows; nulls are empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes each, so that temporary arrays stay small."""
    at, rows = 0, len(offsets) - 1
    while at < rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, to
        at = to


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and first byte of every word, and the offsets of the rows among the words."""
    inside = ~_SPACE[data]
    if not inside.any():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    begins[heads] = inside[heads]
    starts = np.flatnonzero(begins)
    bytes_of = _LOWER[data[inside]]
    first = np.cumsum(inside)[starts] - 1
    lengths = np.diff(np.append(first, len(bytes_of)))
    place = np.arange(len(bytes_of)) - np.repeat(first, lengths)
    powers = np.cumprod(np.full(int(lengths.max()), _ODD))
    hashes = np.add.reduceat(_MULTIPLIERS[bytes_of] * powers[place], first)
    return mix(hashes + lengths.astype(np.uint64)), starts, np.searchsorted(starts, offsets)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words of one row, in order; one for a shorter, non-empty row."""
    if len(words) == 0:
        return words
    size = min(k, len(words))
    n = len(words) - size + 1
    total = np.full(n, size, np.uint64)
    for i in range(size):
        total += words[i : i + n] * _PLACES[i]
    return mix(total)
