"""Numpy helpers for text columns inside tasks.

Texts arrive as Arrow batches and are read as one flat byte array with offsets, so words and rolling
hashes are found for thousands of texts in one vectorised pass.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

from premia.session import tune

# Bytes of text worked on at a time. A longer text is worked on alone.
PIECE_BYTES = 1 << 18

try:
    _LIBC = ctypes.CDLL("libc.so.6")
except OSError:  # another C library, which has no such call
    _LIBC = None

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Words between the six ASCII white-space characters, and words of letters and digits, as tables over
# the bytes of UTF-8. All bytes of characters beyond ASCII belong to words.
SPACED = np.ones(256, dtype=bool)
SPACED[[32, 9, 10, 11, 12, 13]] = False
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[65:91] = ALNUM[128:] = True

_BASE = 0x9E3779B97F4A7C15
_BYTE_CODES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of this package: small Arrow batches, because one text may be very long."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    return spark


def flat_texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text or binary column, and where each value starts (one more for the end). NULL: empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows with at most ``limit`` bytes, or a single row: (first row, end row, bytes, offsets)."""
    data, offsets = flat_texts(column)
    first, rows = 0, len(offsets) - 1
    while first < rows:
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = min(max(end, first + 1), rows)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end
    release_memory()


def release_memory() -> None:
    """Give freed memory back to the system: Spark keeps idle workers, and they would keep it too."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    forward = np.full(size, _BASE, np.uint64)
    backward = np.full(size, pow(_BASE, -1, 2**64), np.uint64)
    forward[0] = backward[0] = 1
    return np.multiply.accumulate(forward), np.multiply.accumulate(backward)


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, modulo 2^64."""
    return _powers(1 << max(19, int(size).bit_length()))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    values *= np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, the same wherever the span stands."""
    forward, backward = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_CODES[data] * forward[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * backward[starts] + (ends - starts).astype(np.uint64))


def word_spans(data: np.ndarray, offsets: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of all texts: byte starts, byte ends, and the first word of each text (one more for the end)."""
    inside = letters[data]
    edges = offsets[offsets < len(data)]
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    before[edges] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[:-1] = inside[1:]
    if len(data):
        after[-1] = False
    after[edges[edges > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each run of ``size`` word hashes."""
    count = max(len(words) - size + 1, 0)
    total = np.full(count, size, np.uint64)
    for i in range(size):
        total = total * np.uint64(0x9FB21C651E98DF25) + words[i : i + count]
    return mixed(total)


def grams_at(words: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """``gram_hashes`` at some starts only."""
    total = np.full(len(starts), size, np.uint64)
    for i in range(size):
        total = total * np.uint64(0x9FB21C651E98DF25) + words[starts + i]
    return mixed(total)


def window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each window of ``width`` keys."""
    count = len(keys) - width + 1
    if count <= 0:
        return keys[:0]
    padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:count], left[width - 1 : width - 1 + count])
