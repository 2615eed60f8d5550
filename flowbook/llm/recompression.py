"""Removal of repeated word windows by recompression.

Words are named, and rounds name maximal runs of one symbol and then pairs of neighbours; a pair is named when its
left symbol is of the left half of the names and its right one of the right half.  A name is a hash of what it
stands for, so every task gives equal parts equal names, over the whole corpus, without a table of names.  For each symbol the
words its existence depends on are followed through the rounds: a symbol whose words all lie in a window is in every
copy of the window.  The window belongs to the symbol with the least name among those, and Spark's rounds over the
names (see ``repeats``) find what is shared and verify it window by window.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import computed_once
from .flat import mix, range_hashes, rolling, slices, small_batches, word_hashes, word_spans
from .repeats import covered, keyed, once_per_text, owners, packed_names, passes, segments, shared_filter, with_spans

WINDOW = 50
ROUNDS = 4
# Marks hold several numbers for each window, so texts are taken in smaller slices than elsewhere.
SLICE = 1 << 19
_U = np.uint64


def _neighbours(low: np.ndarray, high: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, ...]:
    """What the symbol before and the one after depend on; at a text's edge, one word beyond the edge."""
    joined = text[1:] == text[:-1]
    before = np.r_[False, joined], np.r_[joined, False]
    prev_low = np.where(before[0], np.r_[low[:1], low[:-1]], low - 1)
    prev_high = np.where(before[0], np.r_[high[:1], high[:-1]], high)
    next_low = np.where(before[1], np.r_[low[1:], low[-1:]], low)
    next_high = np.where(before[1], np.r_[high[1:], high[-1:]], high + 1)
    return prev_low, prev_high, next_low, next_high


def symbols(names: np.ndarray, text: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names after the rounds, with the begin and end of the words each one depends on; ``text`` tells texts apart."""
    low = np.arange(len(names))
    high = low + 1
    for level in range(rounds):
        if not len(names):
            break
        # A run, of one symbol too, depends on the symbols that end it on either side.
        at = np.flatnonzero(np.r_[True, (names[1:] != names[:-1]) | (text[1:] != text[:-1])])
        many = np.diff(np.r_[at, len(names)])
        low, high, text = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), text[at]
        base = names[at]
        names = np.where(many > 1, mix(base * _U(0x9FB21C651E98DF25) + many.astype(np.uint64) + _U(2 * level + 1)), base)
        prev_low, prev_high, next_low, next_high = _neighbours(low, high, text)
        low, high = np.minimum(np.minimum(low, prev_low), next_low), np.maximum(np.maximum(high, prev_high), next_high)
        # Pairs: a left symbol without a mate depends on the next one, a right one on the one before.
        right = mix(names + _U(0x632BE59BD9B4E019 * (level + 1) & 0xFFFFFFFFFFFFFFFF)) & _U(1) == 1
        joins = np.r_[~right[:-1] & right[1:] & (text[:-1] == text[1:]), False]
        second = np.r_[False, joins[:-1]]
        prev_low, prev_high, next_low, next_high = _neighbours(low, high, text)
        low_alone = np.where(right, np.minimum(prev_low, low), np.minimum(next_low, low))
        high_alone = np.where(right, np.maximum(prev_high, high), np.maximum(next_high, high))
        keep = np.flatnonzero(~second)
        mate = np.minimum(keep + 1, len(names) - 1)
        pair = joins[keep]
        made = mix(mix(names[keep] + _U(level + 1)) * _U(0xD1342543DE82EF95) + names[mate])
        low = np.where(pair, np.minimum(low[keep], low[mate]), low_alone[keep])
        high = np.where(pair, np.maximum(high[keep], high[mate]), high_alone[keep])
        names, text = np.where(pair, made, names[keep]), text[keep]
    return names, low, high


def marks_of(hashes: np.ndarray, text: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Name, first window and number of windows of each mark of consecutive texts (windows count over all words)."""
    windows = len(hashes) - window + 1
    if windows <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = np.where(text[:windows] == text[window - 1:], text[:windows], -1)
    names, low, high = symbols(hashes, text)
    owner = owners(np.maximum(high - window, 0), np.minimum(low + 1, windows), names, windows)
    start, size = segments(owner, inside)
    first = owner[start]
    # Without a symbol of its own, each window is a mark named by its content.
    alone = first < 0
    where = np.concatenate((start[~alone], np.concatenate([np.zeros(0, np.int64)] + [np.arange(a, a + n) for a, n in zip(start[alone], size[alone])])))
    many = np.concatenate((size[~alone], np.ones(int(size[alone].sum()), np.int64)))
    content = rolling(hashes, window, 3)
    # The words a symbol depends on lie in each of its windows too, and make its mark's name hard to meet by chance.
    of = first[~alone]
    name = np.concatenate((mix(names[of] + range_hashes(hashes, low[of], high[of])), mix(content[where[len(first) - int(alone.sum()):]] + _U(1))))
    return name, where, many


def remove_repeats(docs: DataFrame, window: int = WINDOW, carry: Sequence[str] = ()) -> DataFrame:
    """``doc_id, th, n_words, n_removed, kept`` per document; ``kept`` is the kept words joined by one space.

    Needs ``doc_id, text``; the columns in ``carry`` come along as ``c_`` and their name, others are ignored.  A word goes if a window of ``window`` words that covers it also
    starts in a document with a smaller ``doc_id``, judged on the input.  A null or empty text, and one shorter than
    the window, stays as it is.  A document with a null ``doc_id`` has no place in the order: it is kept whole and
    removes nothing.  Rows with one ``doc_id`` are not compared with each other; each gets its own result.  An
    empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = keyed(docs)
    live = texts.where("doc IS NOT NULL")

    def name_marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def names() -> Iterator[np.ndarray]:
            for batch in batches:
                for _, _, data, offsets in slices(batch.column("text"), SLICE):
                    hashes, _, _, text = word_hashes(data, offsets)
                    name, where, _ = marks_of(hashes, text, window)
                    yield once_per_text(name, text[where])

        return packed_names(names())

    shared = spark.sparkContext.broadcast(shared_filter(live.select("text").mapInArrow(name_marks, "part int, names binary")))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            docs_, ths = batch.column("doc").to_numpy(), batch.column("th").to_numpy()
            for lo, hi, data, offsets in slices(batch.column("text"), SLICE):
                hashes, _, _, text = word_hashes(data, offsets)
                name, where, many = marks_of(hashes, text, window)
                kept = passes(bits, name)
                name, where, many = name[kept], where[kept], many[kept]
                begin = np.searchsorted(text, np.arange(hi - lo))
                content = rolling(hashes, window, 3).view(np.int64)
                ends = np.concatenate(([0], np.cumsum(many)))
                flat = content[np.arange(int(ends[-1])) + np.repeat(where - ends[:-1], many)] if len(where) else content[:0]
                row = text[where]
                yield pa.RecordBatch.from_arrays([
                    pa.array(name.view(np.int64)), pa.array(docs_[lo + row]), pa.array(ths[lo + row]), pa.array((where - begin[row]).astype(np.int64)),
                    pa.array(many.astype(np.int64)), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat)),
                ], names=["name", "doc", "th", "p", "n", "content"])

    marks = computed_once(live.mapInArrow(emit, "name long, doc long, th long, p long, n long, content array<bigint>"), "marks")

    def look(contents: DataFrame) -> DataFrame:
        at = contents.select("name", "cd", "d0", F.posexplode("content").alias("i", "w"))
        least = at.groupBy("name", "w").agg(F.min("d0").alias("least")).select(F.col("name").alias("name_"), F.col("w").alias("w_"), "least")
        return at.join(least, (F.col("name") == F.col("name_")) & (F.col("w") == F.col("w_")) & (F.col("d0") > F.col("least"))).select(
            "name", "cd", F.col("i").cast("long").alias("i"), F.lit(1).cast("long").alias("m"),
        )

    joined = with_spans(keyed(docs, carry), covered(marks, look))
    carried = joined.select(*[f"`c_{c}`" for c in carry]).schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column("spans").to_pylist()
            for lo, hi, data, offsets in slices(batch.column("text"), SLICE):
                first, end, text = word_spans(data, offsets)
                bounds = np.searchsorted(text, np.arange(hi - lo + 1))
                raw = data.tobytes()
                rows = []
                for k in range(hi - lo):
                    a, b = int(bounds[k]), int(bounds[k + 1])
                    gone = np.zeros(b - a + 1, np.int64)
                    for s in spans[lo + k] or ():
                        gone[s["p"]] += 1
                        gone[s["p"] + s["n"] + window - 1] -= 1
                    stay = np.cumsum(gone[:-1]) == 0
                    kept = b" ".join([raw[x:y] for x, y in zip(first[a:b][stay].tolist(), end[a:b][stay].tolist())])
                    rows.append((b - a, int((~stay).sum()), kept))
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc").slice(lo, hi - lo), batch.column("th").slice(lo, hi - lo), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([r[2] for r in rows], pa.binary()).cast(pa.string()), *[batch.column(c).slice(lo, hi - lo) for c in carried.names],
                ], names=["doc_id", "th", "n_words", "n_removed", "kept", *carried.names])

    own = T.StructType.fromDDL("doc_id long, th long, n_words long, n_removed long, kept string")
    return joined.mapInArrow(cut, T.StructType(own.fields + carried.fields))
