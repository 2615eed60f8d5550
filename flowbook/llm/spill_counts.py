"""Cross-tokenizer alignment with corpus-wide counts of overlapping token pairs, by external spill counting.

A segment of documents leaves one sorted run for each radix of the A id: its different pairs in blocks, with the
number of documents of each, and the documents' places beside them, all compressed.  Runs of one radix are merged by
a heap over their blocks, ``FAN_IN`` at a time, until one is left; it is in order of the A id, so the highest count
of an A id is known when the id ends.  The counts then meet the runs' places, and each run streams its documents'
contributions back.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import computed_once
from .alignment import aligner, default_paths
from .flat import packed, slices, unpacked

RADIX = 16
FAN_IN = 64
BLOCK = 1 << 14
SEGMENT_BYTES = 4 << 20
CHUNK_PAIRS = 1 << 20

_RUN = "segment long, radix int, slot int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<binary>, places binary"
_ARROW = pa.schema([
    ("segment", pa.int64()), ("radix", pa.int32()), ("slot", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
    ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("pairs", pa.list_(pa.binary())), ("places", pa.binary()),
])


def in_blocks(keys: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """Ascending keys, as steps within a block, with their counts."""
    return [packed(np.diff(keys[k:k + BLOCK], prepend=0), counts[k:k + BLOCK]) for k in range(0, len(keys), BLOCK)]


def block_of(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, counts = unpacked(block, 2)
    return np.cumsum(steps), counts


def merged(runs: list[list[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys and summed counts of sorted runs, in order; one block of each run is open.

    The heap holds the last key of each open block; up to the least of them every run has shown what it has.
    """
    rest = [iter(run) for run in runs]
    open_blocks: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    heap: list[tuple[int, int]] = []

    def turn(k: int) -> None:
        block = next(rest[k], None)
        if block is None:
            open_blocks.pop(k, None)
        else:
            open_blocks[k] = block_of(block)
            heapq.heappush(heap, (int(open_blocks[k][0][-1]), k))

    for k in range(len(runs)):
        turn(k)
    while heap:
        bound = heap[0][0]
        keys, counts = [], []
        for k, (own, many) in open_blocks.items():
            cut = int(np.searchsorted(own, bound, "right"))
            if cut:
                keys.append(own[:cut]), counts.append(many[:cut])
                open_blocks[k] = own[cut:], many[cut:]
        while heap and heap[0][0] == bound:
            turn(heapq.heappop(heap)[1])
        keys, counts = np.concatenate(keys), np.concatenate(counts)
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        yield keys[at], np.add.reduceat(counts, at)


def with_maxima(stream: Iterator[tuple[np.ndarray, np.ndarray]], size_b: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Keys, counts and whether a count is the highest of its A id; an A id goes on when its last key has come."""
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def closed(keys, counts):
        at = np.flatnonzero(np.r_[True, keys[1:] // size_b != keys[:-1] // size_b])
        highest = np.repeat(np.maximum.reduceat(counts, at), np.diff(np.r_[at, len(keys)]))
        return keys, counts, counts == highest

    for more_keys, more_counts in stream:
        keys, counts = np.concatenate((keys, more_keys)), np.concatenate((counts, more_counts))
        cut = int(np.searchsorted(keys, keys[-1] // size_b * size_b))
        if cut:
            yield closed(keys[:cut], counts[:cut])
            keys, counts = keys[cut:], counts[cut:]
    if len(keys):
        yield closed(keys, counts)


def _places(pairs: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different pairs of each text with their number there, by pair and text; a stretch of links at a time."""
    keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k in range(0, len(pairs), CHUNK_PAIRS):
        found, many = np.unique(pairs[k:k + CHUNK_PAIRS] << 31 | text[k:k + CHUNK_PAIRS], return_counts=True)
        keys.append(found), counts.append(many)
    keys, counts = np.concatenate(keys), np.concatenate(counts)
    if len(pairs) > CHUNK_PAIRS:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        keys, counts = keys[at], np.add.reduceat(counts, at)
    return keys >> 31, keys & (1 << 31) - 1, counts


def spill(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per document with its own numbers (``radix`` null), and one per segment and radix with a run.

    A pair's key puts the radix of its A id first, then the A id, then the B id.  ``places`` are the texts' slots in
    the segment and the pair's number of links there, ordered by key.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = aligner(path_a, path_b)
        shares = -(-found.size_a // RADIX)
        segment = TaskContext.get().partitionId() << 32
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column("text"), SEGMENT_BYTES):
                made = found.align(data, offsets)
                n = hi - lo
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, segment)), pa.nulls(n, pa.int32()), pa.array(np.arange(n, dtype=np.int32)), batch.column("doc_id").slice(lo, n),
                    *[pa.array(c.astype(np.int64)) for c in (made.n_a, made.n_b, made.n_groups, made.n_links)], pa.array(made.groups, pa.string()),
                    pa.nulls(n, pa.list_(pa.binary())), pa.nulls(n, pa.binary()),
                ], schema=_ARROW)
                a, b = made.pairs // found.size_b, made.pairs % found.size_b
                keys, slots, links = _places((a % RADIX * shares + a // RADIX) * found.size_b + b, made.pair_text)
                edges = np.searchsorted(keys, np.arange(RADIX + 1) * shares * found.size_b)
                for radix in range(RADIX):
                    part = slice(edges[radix], edges[radix + 1])
                    own = keys[part]
                    if len(own):
                        at = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                        row = [
                            segment, radix, None, None, None, None, None, None, None, in_blocks(own[at], np.diff(np.r_[at, len(own)])), packed(slots[part], links[part]),
                        ]
                        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _ARROW)], schema=_ARROW)
                segment += 1

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(build, _RUN)


def pair_counts(runs: DataFrame, size_b: int) -> DataFrame:
    """``radix, pairs, best``: the counts of all pairs of a radix in blocks, and a bit per key for an A id's highest.

    The number of pairs is bounded by the two vocabularies, whatever the corpus.
    """

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        keys, counts = map(np.concatenate, zip(*merged(group["pairs"].tolist())))
        return pd.DataFrame({"segment": group["segment"].min(), "radix": group["radix"].iloc[0], "pairs": [in_blocks(keys, counts)]})

    def finish(group: pd.DataFrame) -> pd.DataFrame:
        keys, counts, best = map(np.concatenate, zip(*with_maxima(merged(group["pairs"].tolist()), size_b)))
        return pd.DataFrame({"radix": group["radix"].iloc[0], "pairs": [in_blocks(keys, counts)], "best": [np.packbits(best).tobytes()]})

    level = runs.select("segment", "radix", "pairs")
    most = runs.groupBy("radix").count().agg(F.max("count")).first()[0] or 0
    while most > FAN_IN:
        lots = -(-most // FAN_IN)
        # The seed keeps runs that have met once from being dealt together again.
        lot = F.pmod(F.xxhash64("segment", F.lit(lots)), F.lit(lots))
        level = computed_once(level.withColumn("lot", lot).groupBy("radix", "lot").applyInPandas(merge, "segment long, radix int, pairs array<binary>"), "merged-runs")
        most = lots
    return computed_once(level.groupBy("radix").applyInPandas(finish, "radix int, pairs array<binary>, best binary"), "pair-counts")


def contributions(runs: DataFrame, counts: DataFrame) -> DataFrame:
    """``segment, slot, n_best, count_sum`` for each radix a document has pairs in; runs are met in lots of ``FAN_IN``."""
    lots = runs.groupBy("radix").agg(F.ceil(F.count("*") / FAN_IN).cast("int").alias("lots"))
    dealt = runs.join(F.broadcast(lots), "radix").select("radix", F.pmod(F.xxhash64("segment"), F.col("lots")).cast("int").alias("lot"), "segment", "pairs", "places")
    repeated = counts.join(F.broadcast(lots), "radix").select("radix", F.explode(F.sequence(F.lit(0), F.col("lots") - 1)).alias("lot"), "pairs", "best")

    def back(own: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(own):
            keys, many = map(np.concatenate, zip(*map(block_of, known["pairs"].iloc[0])))
            best = np.unpackbits(np.frombuffer(known["best"].iloc[0], np.uint8), count=len(keys)).astype(np.int64)
            for segment, blocks, places in zip(own["segment"], own["pairs"], own["places"]):
                mine, texts = map(np.concatenate, zip(*map(block_of, blocks)))
                at = np.repeat(np.searchsorted(keys, mine), texts)
                slots, links = unpacked(places, 2)
                order = np.argsort(slots, kind="stable")
                at, slots, links = at[order], slots[order], links[order]
                cut = np.flatnonzero(np.r_[True, slots[1:] != slots[:-1]])
                out.append(pd.DataFrame({
                    "segment": segment, "slot": slots[cut].astype(np.int32), "n_best": np.add.reduceat(links * best[at], cut),
                    "count_sum": np.add.reduceat(links * many[at], cut),
                }))
        return pd.concat(out) if out else pd.DataFrame({"segment": [], "slot": [], "n_best": [], "count_sum": []}).astype("int64").astype({"slot": "int32"})

    return dealt.groupBy("radix", "lot").cogroup(repeated.groupBy("radix", "lot")).applyInPandas(back, "segment long, slot int, n_best long, count_sum long")


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` per row of ``docs``.

    Needs ``doc_id, text``; other columns are ignored.  Both files encode a space and the text; special tokens'
    strings are plain text.  Groups end where tokens of both sides end at one byte; a link is a token of A and one of B
    that share a byte; a pair's count is the number of rows that hold it.  A null or empty text, and one that either
    file does not give back byte by byte, has no tokens: zeros and an empty digest.  Of counts that are equal, all are
    an A id's highest.  Repeated rows and rows with one or no ``doc_id`` are documents of their own.  A very long text
    is a segment of its own.  An empty table gives no rows.
    """
    defaults = default_paths()
    path_a, path_b = path_a or defaults[0], path_b or defaults[1]
    spilled = computed_once(spill(docs, path_a, path_b), "runs")
    runs = spilled.where("radix IS NOT NULL")
    counts = pair_counts(runs, aligner(path_a, path_b).size_b)
    summed = contributions(runs, counts).groupBy("segment", "slot").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    own = spilled.where("radix IS NULL").select("segment", "slot", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    return own.join(summed, ["segment", "slot"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")], "groups_sha256",
    )
