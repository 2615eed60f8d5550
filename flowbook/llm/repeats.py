"""Windows that also start in a document with a smaller id: what substring removal on words and on bytes share.

A *mark* is one place of a document whose name depends on the text around it alone, with the ``n`` windows from ``p``
on that belong to it: a window belongs to the same mark wherever it occurs.  So equal windows meet under one name,
at the same number in their mark, and everything else is decided there:

1. names in two documents at least are found by one count of names;
2. a filter of fixed size lets the second pass over the texts emit only marks with such names, with their content;
3. marks with equal content are settled by the smallest document that has it;
4. only different contents of one name go on, one row each, to the method that looks into them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import computed_once
from .flat import packed, unpacked

# A name has two places in a filter: its first bits, and the last of its first ``NAME_BITS``.  It passes if both are marked.
FILTER_BITS = 1 << 26
NAME_BITS, NAME_PARTS = 40, 64
CHUNK_NAMES = 1 << 20


def packed_names(batches: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Names (each once per text) as rows ``part, names``: the sorted first ``NAME_BITS`` bits, as steps, by their highest ones."""
    held, size = [], 0

    def sent() -> pa.RecordBatch:
        names = np.concatenate(held) >> np.uint64(64 - NAME_BITS)
        names.sort()
        edges = np.searchsorted(names, np.arange(NAME_PARTS + 1, dtype=np.uint64) << np.uint64(NAME_BITS - (NAME_PARTS - 1).bit_length()))
        rows = [(k, packed(np.diff(names[lo:hi].view(np.int64), prepend=0))) for k, (lo, hi) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())) if hi > lo]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["part", "names"])

    for names in batches:
        held.append(names.view(np.uint64))
        size += len(names)
        if size >= CHUNK_NAMES:
            yield sent()
            held, size = [], 0
    if size:
        yield sent()


def shared_filter(packed_rows: DataFrame) -> np.ndarray:
    """The filter over all names that two texts have at least, from rows of ``packed_names``.

    Two names with equal first bits pass as shared: then a name too many passes the filter, never one too few.  A part of
    names is merged in slices of its range, so that no task holds more than one slice of all names.
    """
    shift = NAME_BITS - (FILTER_BITS - 1).bit_length()

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            held += batch.column("names").to_pylist()
        # Stretches of a few filter words each, one after the other: of every run only what lies there is open.
        runs = [np.cumsum(unpacked(block, 1)[0]) for block in held]
        if not runs:
            return
        low, high = min(int(r[0]) for r in runs), max(int(r[-1]) for r in runs)
        step = max(1 << shift, -(-(high - low + 1) // max(1, sum(map(len, runs)) // CHUNK_NAMES + 1)))
        step = -(-step >> shift) << shift
        for start in range(low >> shift << shift, high + 1, step):
            names = np.concatenate([r[np.searchsorted(r, start):np.searchsorted(r, start + step)] for r in runs])
            names.sort()
            again = names[1:][names[1:] == names[:-1]].astype(np.int64)
            at = np.unique(np.concatenate((again >> shift, again & (FILTER_BITS - 1))))
            words, first = np.unique(at >> 6, return_index=True)
            bits = np.bitwise_or.reduceat(np.uint64(1) << (at & 63).astype(np.uint64), first).view(np.int64) if len(at) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(bits)], names=["word", "bits"])

    dealt = packed_rows.repartition(NAME_PARTS, "part")
    return _bits(dealt.mapInArrow(mark, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")))


def _bits(rows: DataFrame) -> np.ndarray:
    """Filter words as one array; at most ``FILTER_BITS / 64`` rows."""
    found = rows.toArrow()
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return out


def name_filter(names: DataFrame) -> np.ndarray:
    """Two bits per hashed name, ``FILTER_BITS`` in all whatever the input; it may pass a name too many, never too few."""
    # Names are hashes already: their bits are the places.
    at = F.array(F.shiftrightunsigned("name", 64 - (FILTER_BITS - 1).bit_length()), F.shiftrightunsigned("name", 64 - NAME_BITS).bitwiseAND(FILTER_BITS - 1))
    placed = names.select(F.explode(at).alias("at")).select(F.shiftright("at", 6).alias("word"), F.expr("shiftleft(1L, CAST(at & 63 AS INT))").alias("bit"))
    rows = placed.groupBy("word").agg(F.bit_or("bit").alias("bits"))
    return _bits(rows)


def keyed(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """``doc, th, text``: the document's id, a hash of its text to tell rows with one id apart, and the text."""
    kept = [F.col(f"`{c}`").alias(f"c_{c}") for c in carry]
    return docs.select(F.col("doc_id").cast("long").alias("doc"), F.xxhash64("text").alias("th"), "text", *kept)


def covered(marks: DataFrame, look: Callable[[DataFrame], DataFrame], contents_of: Callable[[np.ndarray], DataFrame] | None = None) -> DataFrame:
    """``doc, th, p, n``: runs of windows that also start in a document with a smaller id.

    ``marks`` has ``name, doc, th, p, n, content``; equal contents of one name are told by a digest ``cd``.  ``look``
    gets ``name, cd, content, d0`` (the smallest document with that content), for names with two contents at least,
    and returns ``name, cd, i, m``: windows ``i`` to ``i + m`` of the content that also occur in another content with
    a smaller ``d0``.  The contents themselves pass one shuffle, and only where ``look`` needs them.

    With ``contents_of``, marks have the digest ``cd`` in place of the content, and contents are taken from the texts again:
    it gets a filter and returns ``name, cd, doc, content`` of the marks whose names pass it.
    """
    digest = F.col("cd") if contents_of else F.xxhash64("content").alias("cd")
    lean = marks.select("name", digest, "doc", "th", "p", "n")
    first = computed_once(lean.groupBy("name", "cd").agg(F.min("doc").alias("d0"), F.max("doc").alias("d1")), "contents")
    same = (F.col("name") == F.col("n2")) & (F.col("cd") == F.col("c2"))
    several = first.groupBy(F.col("name").alias("several")).agg(F.count("*").alias("k"), F.min("d0").alias("lo"), F.max("d0").alias("hi")).where("k > 1 AND lo < hi")
    wanted = computed_once(first.join(several, F.col("name") == F.col("several")).select(F.col("name").alias("n2"), F.col("cd").alias("c2"), "d0"), "ambiguous")
    bits = name_filter(wanted.select(F.col("n2").alias("name")).distinct())
    kept = contents_of(bits) if contents_of else passing(marks.select("name", digest, "doc", "content"), bits)
    contents = kept.join(wanted, same & (F.col("doc") == F.col("d0"))).select("name", "cd", "content", "d0")
    inner = computed_once(look(contents.dropDuplicates(["name", "cd"])), "inner")
    runs = inner.groupBy(F.col("name").alias("n3"), F.col("cd").alias("c3")).agg(F.collect_list(F.struct("i", "m")).alias("runs"))
    settled = first.join(runs, (F.col("name") == F.col("n3")) & (F.col("cd") == F.col("c3")), "left").where("d0 < d1 OR runs IS NOT NULL").select(
        F.col("name").alias("n2"), F.col("cd").alias("c2"), "d0", "runs")
    met = lean.join(settled, same)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("i"), F.col("n").alias("m")))
    run = F.explode(F.when(F.col("doc") > F.col("d0"), whole).otherwise(F.col("runs"))).alias("run")
    return computed_once(met.select("doc", "th", "p", run).select("doc", "th", (F.col("p") + F.col("run.i")).alias("p"), F.col("run.m").alias("n")), "covered")


def passing(frame: DataFrame, bits: np.ndarray, let_through: bool = True) -> DataFrame:
    """The rows of a frame whose ``name`` the filter lets through, or those it stops."""
    shared = frame.sparkSession.sparkContext.broadcast(bits)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("name").to_numpy().view(np.uint64)
            yield batch.filter(pa.array(passes(shared.value, names) == let_through))

    return frame.mapInArrow(keep, frame.schema)


def with_spans(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """The rows of ``texts`` (as ``keyed`` gives them) with ``spans``, the array of their runs (null without one).

    A filter of fixed size over the documents that have runs keeps the texts of most others out of the shuffle.
    """
    held = spans.groupBy("doc", "th").agg(F.collect_set(F.struct("p", "n")).alias("spans"))
    held = held.select(F.col("doc").alias("doc_"), F.col("th").alias("th_"), "spans")
    bits = name_filter(spans.select(F.xxhash64("doc").alias("name")).distinct())
    named = texts.withColumn("name", F.xxhash64("doc"))
    some = passing(named, bits).join(held, (F.col("doc") == F.col("doc_")) & (F.col("th") == F.col("th_")), "left").drop("doc_", "th_", "name")
    none = F.lit(None).cast(held.schema["spans"].dataType).alias("spans")
    return some.unionByName(passing(named, bits, False).drop("name").select("*", none))


def owners(low: np.ndarray, high: np.ndarray, rank: np.ndarray, windows: int) -> np.ndarray:
    """For each window the item of lowest rank among those whose range ``low:high`` of windows holds it, or -1.

    Items with one rank are told apart by place: the first wins.
    """
    order = np.lexsort((low, rank))
    best = np.full(windows, len(rank), np.int64)
    place = np.empty(len(rank), np.int64)
    place[order] = np.arange(len(rank))
    # Sparse-table style: a range is the union of two powers of two, pushed down level by level.
    size = np.maximum(high - low, 0)
    live = size > 0
    if not live.any():
        return np.full(windows, -1, np.int64)
    top = int(size.max()).bit_length() - 1
    tables = []
    for k in range(top + 1):
        t = np.full(max(windows - (1 << k) + 1, 0), len(rank), np.int64)
        tables.append(t)
    level = np.zeros(len(rank), np.int64)
    level[live] = np.floor(np.log2(size[live])).astype(np.int64)
    for k in range(top + 1):
        rows = live & (level == k)
        np.minimum.at(tables[k], low[rows], place[rows])
        np.minimum.at(tables[k], high[rows] - (1 << k), place[rows])
    for k in range(top, 0, -1):
        half = 1 << (k - 1)
        np.minimum(tables[k - 1][:len(tables[k])], tables[k], out=tables[k - 1][:len(tables[k])])
        tail = tables[k - 1][half:half + len(tables[k])]
        np.minimum(tail, tables[k], out=tail)
    best[:len(tables[0])] = tables[0]
    out = np.full(windows, -1, np.int64)
    found = best < len(rank)
    out[found] = order[best[found]]
    return out


def passes(bits: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Which names the filter lets through."""
    at = (names >> np.uint64(64 - (FILTER_BITS - 1).bit_length())).astype(np.int64)
    passed = (bits[at >> 6] >> (at & 63)) & 1 == 1
    # Few names get to the second look.
    some = np.flatnonzero(passed)
    at = (names[some] >> np.uint64(64 - NAME_BITS)).astype(np.int64) & (FILTER_BITS - 1)
    passed[some] = (bits[at >> 6] >> (at & 63)) & 1 == 1
    return passed


def segments(owner: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First window and length of each run of windows with one owner and one text; windows of text -1 are left out."""
    if not len(owner):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (text[1:] != text[:-1])])
    size = np.diff(np.r_[cut, len(owner)])
    live = text[cut] >= 0
    return cut[live], size[live]


def once_per_text(names: np.ndarray, text: np.ndarray) -> np.ndarray:
    """The names of each text once, as Spark's longs."""
    order = np.lexsort((text, names))
    names, text = names[order], text[order]
    new = np.r_[True, (names[1:] != names[:-1]) | (text[1:] != text[:-1])] if len(names) else np.zeros(0, bool)
    return names[new].view(np.int64)
