"""Vectorised words, word hashes and windows of whole texts, for use inside Arrow batches.

A word is a run of bytes other than space and \\x09-\\x0D. Columns are worked through in slices of
a quarter of a megabyte, so a batch of long texts needs little memory; one text is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 18
BATCH_ROWS, BATCH_BYTES = 500, 4 << 20
SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_VALUES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)
_WINDOW_FACTORS = np.random.default_rng(20240608).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_powers = {_BASE: np.ones(1, np.uint64), _INVERSE: np.ones(1, np.uint64)}


def lean_batches(spark: SparkSession) -> None:
    """Hand rows to Python in small batches: rows here hold whole texts, shingle sets or vectors.

    Executors and their workers hold a few batches at a time, so this bounds their memory.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def id_remainder(doc_id: str, of: int) -> Column:
    """crc32 of the id's decimal text modulo ``of``; NULL ids count as an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % of


def gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Narrow rows put together again, some ``rows`` at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


def slices(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, bytes, offsets)`` of consecutive rows; NULL counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer else np.empty(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, "right")) - 1)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last
    pa.default_memory_pool().release_unused()  # workers live on, and their memory counts with the executor's


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and per text the number of words before it (one more at the end)."""
    inside = ~SPACES[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = inside
    border = np.zeros(len(data) + 1, bool)
    border[offsets] = True
    starts = np.flatnonzero(after & (~before | border))
    ends = np.flatnonzero(before & (~after | border))
    return starts, ends, np.searchsorted(starts, offsets)


def _power(base: int, n: int) -> np.ndarray:
    if len(_powers[base]) < n:
        steps = np.full(max(n, SLICE_BYTES * 2), base, np.uint64)
        steps[0] = 1
        _powers[base] = np.multiply.accumulate(steps)
    return _powers[base][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, by differences of a running polynomial over the bytes."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * _power(_BASE, len(data)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _power(_INVERSE, len(data) + 1)[starts])


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words of one text; none when it is shorter."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = hashes[:n] * _WINDOW_FACTORS[0]
    for k in range(1, width):
        out += hashes[k : n + k] * _WINDOW_FACTORS[k]
    return mix(out)


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes of one text; a shorter text is one shingle, an empty one has none."""
    if 0 < len(hashes) < width:
        return window_hashes(hashes, len(hashes)) + np.uint64(len(hashes))
    return np.unique(window_hashes(hashes, width))


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of set flags within each text."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]
