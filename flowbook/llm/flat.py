"""Texts of an Arrow batch as one flat byte array, and its words, without a Python loop over words.

A word is a maximal run of bytes other than space and 0x09-0x0D, which is ``[^\\x20\\x09-\\x0D]+`` on the text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import SparkSession

SLICE_BYTES = 2 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit (the splitmix finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=None)
def _byte_codes() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


@lru_cache(maxsize=2)
def powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


@lru_cache(maxsize=1)
def _libc():
    try:
        return ctypes.CDLL("libc.so.6")
    except OSError:  # another C library keeps what it has
        return None


BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Let Spark hand texts to Python a few MB at a time, not ten thousand rows; a setting of the session's own stays."""
    if BATCH not in dict(spark.conf.getAll):
        spark.conf.set(BATCH, "4m")


def give_back() -> None:
    """Return memory that is free to the system: a Python worker lives on for later stages, beside other workers."""
    pa.default_memory_pool().release_unused()
    if _libc() is not None:
        _libc().malloc_trim(0)


def texts_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the n + 1 offsets into them; a null text is empty.  Texts are not copied where none is null."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    width = np.int64 if column.type in (pa.large_string(), pa.large_binary()) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, width, len(column) + 1, column.offset * width().itemsize).astype(np.int64) if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows ``lo:hi`` at a time, with about ``limit`` bytes of text each (a longer text comes alone)."""
    data, offsets = texts_of(column)
    lo, rows = 0, len(offsets) - 1
    while lo < rows:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi
    give_back()


def word_spans(data: np.ndarray, offsets: np.ndarray, cuts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end byte and text number of each word; ``cuts`` are bytes at which a word is cut in two as well."""
    solid = ~_SPACE[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] = solid[edges]
    ends[edges - 1] = solid[edges - 1]
    if cuts is not None:
        begins[cuts], ends[cuts - 1] = True, True
    first = np.flatnonzero(begins)
    return first, np.flatnonzero(ends) + 1, np.searchsorted(offsets, first, "right") - 1


def span_hashes(data: np.ndarray, first: np.ndarray, end: np.ndarray, limit: int = 1 << 19) -> np.ndarray:
    """A 64-bit hash of each span of bytes (spans ascend and do not overlap), from prefix sums of a polynomial."""
    out = np.empty(len(first), np.uint64)
    lo = 0
    while lo < len(first):
        hi = max(lo + 1, int(np.searchsorted(end, first[lo] + limit, "right")))
        base, stop = int(first[lo]), int(end[hi - 1])
        size = 1 << max(limit.bit_length(), (stop - base).bit_length())
        sums = np.zeros(stop - base + 1, np.uint64)
        np.cumsum(_byte_codes()[data[base:stop]] * powers(_BASE, size)[:stop - base], out=sums[1:])
        a, b = first[lo:hi] - base, end[lo:hi] - base
        out[lo:hi] = mix((sums[b] - sums[a]) * powers(_INVERSE, size)[a] + (b - a).astype(np.uint64))
        lo = hi
    return out


def word_hashes(data: np.ndarray, offsets: np.ndarray, cuts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte, end byte and text number of each word."""
    first, end, text = word_spans(data, offsets, cuts)
    return span_hashes(data, first, end), first, end, text


def rolling(values: np.ndarray, width: int, seed: int) -> np.ndarray:
    """A 64-bit hash of every ``width`` consecutive values, in about 2 log2(width) passes."""
    if len(values) < width:
        return np.zeros(0, np.uint64)
    step, have, power = values, 1, seed | 1
    parts: list[tuple[np.ndarray, int]] = []
    while have <= width:
        if width & have:
            parts.append((step, have))
        if 2 * have > width:
            break
        power = (power * 0xD1342543DE82EF95 + 0x632BE59BD9B4E019) | 1
        step = mix(step[:len(step) - have] * np.uint64(power & ((1 << 64) - 1)) + step[have:])
        have *= 2
    count = len(values) - width + 1
    total, at = np.zeros(count, np.uint64), 0
    for step, have in parts:
        total = mix(total * np.uint64(0x9FB21C651E98DF25) + step[at:at + count] + np.uint64(have))
        at += have
    return total


def range_hashes(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """A 64-bit hash of ``values[low:high]`` for each pair of bounds, from prefix sums of a polynomial."""
    size = 1 << len(values).bit_length()
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(_BASE, size)[:len(values)], out=sums[1:])
    return mix((sums[high] - sums[low]) * powers(_INVERSE, size)[low] + (high - low).astype(np.uint64))


def packed(*columns: np.ndarray) -> bytes:
    """Columns of one length as bytes: each number's lowest bytes first, then the next ones, compressed by zstd."""
    planes = b"".join(np.ascontiguousarray(c, np.dtype("<u8")).view(np.uint8).reshape(-1, 8).T.tobytes() for c in columns)
    return zstandard.ZstdCompressor(level=1).compress(planes)


def unpacked(block: bytes, columns: int) -> list[np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(block), np.uint8).reshape(columns, 8, -1)
    return [np.ascontiguousarray(p.T).view("<i8").ravel() for p in planes]
