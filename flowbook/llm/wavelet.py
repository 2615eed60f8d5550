"""Token ids stored as wavelet matrices: one compressed file per shard, with access, count and occurrence lookup.

A shard is a range of ``doc_id``.  Its file holds segments of consecutive whole documents; each segment is a
wavelet matrix: one bit-plane per id bit, from the highest, every plane sorted stably by the bits above it, with
the number of ones before each block of 512 bits (rank) and the number of zeros of each plane.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import computed_once
from .flat import slices
from .tokens import END_ID, default_path, encoder

BLOCK = 512
SEGMENT_TOKENS = 1 << 18
SEGMENT = (
    "shard int, segment int, shard_start long, n long, bits int, doc_ids array<bigint>, counts array<bigint>, "
    "zeros array<bigint>, planes binary, ranks binary"
)
_ARROW = pa.schema([
    ("shard", pa.int32()), ("segment", pa.int32()), ("shard_start", pa.int64()), ("n", pa.int64()), ("bits", pa.int32()),
    ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("zeros", pa.list_(pa.int64())),
    ("planes", pa.binary()), ("ranks", pa.binary()),
])


class WaveletMatrix:
    """Rank, select and access over one segment."""

    def __init__(self, n: int, bits: int, zeros: list[int], planes: bytes, ranks: bytes):
        self.n, self.bits, self.zeros = n, bits, [int(z) for z in zeros]
        self.planes = np.frombuffer(planes, np.uint8).reshape(bits, -1)
        self.ranks = np.frombuffer(ranks, "<u4").reshape(bits, -1)

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        n = len(ids)
        blocks = n // BLOCK + 1
        planes = np.zeros((bits, blocks * BLOCK // 8), np.uint8)
        ranks = np.zeros((bits, blocks), "<u4")
        zeros, rest = [], ids
        for level in range(bits):
            ones = ((rest >> (bits - 1 - level)) & 1).astype(bool)
            packed = np.packbits(ones, bitorder="little")
            planes[level, :len(packed)] = packed
            sums = np.bitwise_count(planes[level]).reshape(blocks, -1).sum(axis=1)
            ranks[level, 1:] = np.cumsum(sums)[:-1]
            zeros.append(n - int(sums.sum()))
            rest = np.concatenate((np.compress(~ones, rest), np.compress(ones, rest)))
        return cls(n, bits, zeros, planes.tobytes(), ranks.tobytes())

    def _bit(self, level: int, i: int) -> int:
        return (int(self.planes[level, i >> 3]) >> (i & 7)) & 1

    def _ones(self, level: int, i: int) -> int:
        """Ones before place ``i`` of a plane."""
        block = i // BLOCK
        row = self.planes[level]
        whole = int(self.ranks[level, block]) + int(np.bitwise_count(row[block * BLOCK // 8:i >> 3]).sum())
        return whole + (int(row[i >> 3]) & ((1 << (i & 7)) - 1)).bit_count() if i & 7 else whole

    def access(self, i: int) -> int:
        """The id at place ``i``."""
        value = 0
        for level in range(self.bits):
            bit = self._bit(level, i)
            ones = self._ones(level, i)
            i = self.zeros[level] + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _interval(self, value: int, lo: int, hi: int) -> tuple[int, int]:
        for level in range(self.bits):
            a, b = self._ones(level, lo), self._ones(level, hi)
            lo, hi = (self.zeros[level] + a, self.zeros[level] + b) if value >> (self.bits - 1 - level) & 1 else (lo - a, hi - b)
        return lo, hi

    def count(self, value: int, lo: int = 0, hi: int | None = None) -> int:
        """How often ``value`` occurs in places ``lo:hi``."""
        if not 0 <= value < 1 << self.bits:
            return 0
        lo, hi = self._interval(value, lo, self.n if hi is None else hi)
        return hi - lo

    def select(self, value: int, k: int) -> int:
        """The place of occurrence ``k`` (from 0) of ``value``."""
        if not 0 <= k < self.count(value):
            raise IndexError(k)
        at = self._interval(value, 0, self.n)[0] + k
        for level in reversed(range(self.bits)):
            one = value >> (self.bits - 1 - level) & 1
            at = self._place(level, at - self.zeros[level] if one else at, one)
        return at

    def places(self, value: int) -> np.ndarray:
        """The places of all occurrences of ``value``, ascending: one select for all of them, plane by plane."""
        if not 0 <= value < 1 << self.bits:
            return np.zeros(0, np.int64)
        at = np.arange(*self._interval(value, 0, self.n))
        for level in reversed(range(self.bits)):
            if not len(at):
                break
            one = value >> (self.bits - 1 - level) & 1
            row = np.unpackbits(self.planes[level], count=self.n, bitorder="little")
            at = np.flatnonzero(row == one)[at - (self.zeros[level] if one else 0)]
        return at

    def _place(self, level: int, k: int, one: int) -> int:
        """The place of the ``k``-th (from 0) one or zero of a plane."""
        ranks = self.ranks[level].astype(np.int64)
        before = ranks if one else np.arange(len(ranks)) * BLOCK - ranks
        block = int(np.searchsorted(before, k, "right")) - 1
        row = np.unpackbits(self.planes[level, block * BLOCK // 8:(block + 1) * BLOCK // 8], bitorder="little")
        return block * BLOCK + int(np.flatnonzero(row == one)[k - int(before[block])])

    def decode(self) -> np.ndarray:
        """All ids, from the lowest plane up: each plane undoes its own stable split."""
        values = np.zeros(self.n, np.uint32)
        for level in reversed(range(self.bits)):
            ones = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            values[self.zeros[level]:] |= np.uint32(1 << (self.bits - 1 - level))
            before = np.empty_like(values)
            before[np.concatenate((np.flatnonzero(~ones), np.flatnonzero(ones)))] = values
            values = before
        return values


class ShardFile:
    """Access, count and occurrence lookup over all segments of one shard (rows of ``SEGMENT`` in segment order)."""

    def __init__(self, rows: list):
        rows = sorted(rows, key=lambda r: r["segment"])
        self.starts = [int(r["shard_start"]) for r in rows]
        self.parts = [WaveletMatrix(r["n"], r["bits"], r["zeros"], bytes(r["planes"]), bytes(r["ranks"])) for r in rows]
        self.n = sum(p.n for p in self.parts)

    def access(self, i: int) -> int:
        at = int(np.searchsorted(self.starts, i, "right")) - 1
        return self.parts[at].access(i - self.starts[at])

    def count(self, value: int) -> int:
        return sum(p.count(value) for p in self.parts)

    def occurrences(self, value: int) -> Iterator[int]:
        for start, part in zip(self.starts, self.parts):
            for k in range(part.count(value)):
                yield start + part.select(value, k)


def write_shards(docs: DataFrame, folder: str, tokenizer_path: str | None = None, end_id: int = END_ID,
                 segment_tokens: int = SEGMENT_TOKENS) -> None:
    """Encode every text and write the shards' files (zstd-compressed Parquet rows of ``SEGMENT``).

    Needs ``doc_id`` and ``text``; other columns are ignored.  A null or empty text is the end id alone.  Documents
    ascend by ``doc_id``, a null one first; rows with one ``doc_id`` ascend by the text's hash, so repeated rows stay
    rows.  A shard is a range of that order, cut by Spark from a sample of the keys, also inside a repeated key.  A
    segment is closed once it has ``segment_tokens``; a longer document is a segment of its own.
    """
    path = tokenizer_path or default_path()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        shard = TaskContext.get().partitionId()
        ids, doc_ids, counts, size, start, segment = [], [], [], 0, 0, 0

        def closed() -> pa.RecordBatch:
            nonlocal ids, doc_ids, counts, size, start, segment
            matrix = WaveletMatrix.build(np.concatenate(ids), enc.bits)
            row = [shard, segment, start, size, enc.bits, doc_ids, counts, matrix.zeros, matrix.planes.tobytes(), matrix.ranks.tobytes()]
            start, segment = start + size, segment + 1
            ids, doc_ids, counts, size = [], [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _ARROW)], schema=_ARROW)

        for batch in batches:
            keys = batch.column("doc_id").to_pylist()
            for lo, hi, data, offsets in slices(batch.column("text"), 8 << 20):
                found, at = enc.encode(data, offsets, end_id)
                for k in range(hi - lo):
                    ids.append(found[at[k]:at[k + 1]])
                    doc_ids.append(keys[lo + k])
                    counts.append(int(at[k + 1] - at[k]))
                    size += counts[-1]
                    if size >= segment_tokens:
                        yield closed()
        if size:
            yield closed()

    key = [F.col("doc_id"), F.xxhash64("text"), F.monotonically_increasing_id()]
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", key[1].alias("_a"), key[2].alias("_b"))
    ranged = keyed.repartitionByRange("doc_id", "_a", "_b").sortWithinPartitions("doc_id", "_a", "_b").select("doc_id", "text")
    ranged.mapInArrow(build, SEGMENT).write.mode("overwrite").option("compression", "zstd").parquet(folder)


def _shard_starts(spark, folder: str) -> DataFrame:
    """``shard, before_shard``: the ids of all shards before one, from one total per shard."""
    totals = spark.read.schema(SEGMENT).parquet(folder).groupBy("shard").agg(F.sum("n").alias("_n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    # Stored, so that Spark knows its size before it plans the join.
    return computed_once(totals.select("shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("before_shard")), "shard-starts")


def count_tokens(spark, folder: str, values: Sequence[int]) -> DataFrame:
    """``value, n``: how often each of the given ids occurs in all files, by rank on the planes; nothing is decoded.

    An id that does not occur, or is none of the vocabulary, has 0; a repeated one is counted once.
    """
    wanted = sorted(set(values))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[m.count(v) for v in wanted] for m in (WaveletMatrix(r["n"], r["bits"], r["zeros"], r["planes"], r["ranks"]) for r in batch.to_pylist())]
            sums = np.array(found, np.int64).reshape(len(found), len(wanted)).sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(wanted, pa.int64()), pa.array(sums)], names=["value", "n"])

    stored = spark.read.schema(SEGMENT).parquet(folder).select("n", "bits", "zeros", "planes", "ranks")
    named = spark.createDataFrame([(v, 0) for v in wanted], "value long, n long")
    return stored.mapInArrow(count, "value long, n long").unionByName(named).groupBy("value").agg(F.sum("n").alias("n"))


def find_tokens(spark, folder: str, values: Sequence[int]) -> DataFrame:
    """``value, place, doc_id, at``: every occurrence of the given ids, by select on the planes.

    ``place`` counts the ids of all documents in order, ``at`` those of its own document.  Segments are looked up where
    they lie; of one segment, the places of one id are held at a time.
    """
    wanted = sorted(set(values))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                matrix = WaveletMatrix(r["n"], r["bits"], r["zeros"], r["planes"], r["ranks"])
                begins = np.cumsum([0, *r["counts"]])
                for value in wanted:
                    places = matrix.places(value)
                    doc = np.searchsorted(begins, places, "right") - 1
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(places), value, np.int64)), pa.array(places + r["shard_start"] + r["before_shard"]),
                        pa.array(r["doc_ids"], pa.int64()).take(pa.array(doc)), pa.array(places - begins[doc]),
                    ], names=["value", "place", "doc_id", "at"])

    stored = spark.read.schema(SEGMENT).parquet(folder).join(_shard_starts(spark, folder), "shard")
    return stored.mapInArrow(find, "value long, place long, doc_id long, at long")


def read_tokens(spark, folder: str) -> DataFrame:
    """Every document read back from the files: ``doc_id, start, n_tokens, ids`` (ids as little-endian 32-bit values).

    ``start`` is the number of ids of all documents before it.  The order of shards comes from one total per shard.
    """
    stored, starts = spark.read.schema(SEGMENT).parquet(folder), _shard_starts(spark, folder)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = WaveletMatrix(row["n"], row["bits"], row["zeros"], row["planes"], row["ranks"]).decode().astype("<u4")
                counts = np.array(row["counts"], np.int64)
                ends = np.cumsum(counts)
                begins = ends - counts
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["doc_ids"], pa.int64()), pa.array(begins + row["shard_start"] + row["before_shard"]), pa.array(counts),
                    pa.array([ids[a:b].tobytes() for a, b in zip(begins.tolist(), ends.tolist())], pa.binary()),
                ], names=["doc_id", "start", "n_tokens", "ids"])

    return stored.join(starts, "shard").mapInArrow(decode, "doc_id long, start long, n_tokens long, ids binary")
