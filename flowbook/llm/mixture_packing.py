"""Packing by deficit round-robin over source queues, with the deficits in closed form.

Every source is a queue of its documents' tokens.  Each next token comes from the queue that is furthest behind
its target share, so a window of ``window`` tokens holds the sources in their target proportions to within about a
token, and what a source is owed is carried to the next window.  How many tokens each queue has given after ``m``
tokens is a function of ``m`` and the queues' targets alone (the divisor method of Webster), so any task can start
at any window with the right deficits: they are carried across partitions without a sequential pass.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import computed_once
from .flat import give_back, slices, small_batches
from .tokens import END_ID, default_path, encoder, forget_encoders

WINDOW = 4096
PIECE = (
    "doc_id long, source string, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
)


class Schedule:
    """How many tokens each queue has given after ``m`` tokens.

    ``totals`` are the tokens of each queue, ``weights`` its target share (its own share of all tokens by default).
    A queue that runs out leaves its share to the others: the schedule has one phase up to each such moment.
    """

    def __init__(self, totals: np.ndarray, weights: np.ndarray | None = None):
        self.totals = np.asarray(totals, np.int64)
        self.total = int(self.totals.sum())
        self.phases: list[tuple[int, np.ndarray]] = []
        left = self.totals.copy()
        share = self.totals.astype(float) if weights is None else np.asarray(weights, float).copy()
        if (share[left > 0] <= 0).any():
            raise ValueError("every source with tokens needs a target above 0")
        at = 0
        while left.sum():
            live = left > 0
            if weights is None or live.sum() == 1:
                give = left.copy()
            else:
                rate = np.where(live, share, 0) / share[live].sum()
                most = (left[live] / rate[live]).min()
                give = np.minimum(left, np.floor(rate * most + 0.5).astype(np.int64))
                out = live & (left / np.where(live, rate, 1) <= most * (1 + 1e-12))
                give[out] = left[out]
            self.phases.append((at, give))
            at += int(give.sum())
            left = left - give

    def given(self, m: np.ndarray) -> np.ndarray:
        """A row for each ``m``: the tokens that each queue has given by then."""
        out = np.zeros((len(m), len(self.totals)), np.int64)
        for start, give in self.phases:
            size = int(give.sum())
            part = np.clip(m - start, 0, size)
            if part.any():
                out += _webster(part, give, size)
        return out

    def window_of(self, queue: int, token: np.ndarray, window: int) -> np.ndarray:
        """The window that each token (by its number in the queue) falls in.

        A queue gives about evenly within a phase, so the window is guessed from that; binary search goes between the
        guess's neighbours where they hold the token between them, and over all windows elsewhere.
        """
        last = (self.total - 1) // window
        lo, hi = np.zeros(len(token), np.int64), np.full(len(token), last, np.int64)
        guess, before = np.zeros(len(token), np.int64), 0
        for start, give in self.phases:
            own = int(give[queue])
            inside = (token >= before) & (token < before + own)
            guess[inside] = (start + (token[inside] - before) * (int(give.sum()) / max(own, 1))) // window
            before += own
        low, high = np.clip(guess - 1, 0, last), np.clip(guess + 1, 0, last)
        above = self._passed(queue, low - 1, window) <= token
        below = self._passed(queue, high, window) > token
        lo[above], hi[below] = low[above], high[below]
        while (rows := np.flatnonzero(lo < hi)).size:
            mid = (lo[rows] + hi[rows]) // 2
            inside = self._passed(queue, mid, window) > token[rows]
            hi[rows], lo[rows] = np.where(inside, mid, hi[rows]), np.where(inside, lo[rows], mid + 1)
        return lo

    def _passed(self, queue: int, number: np.ndarray, window: int) -> np.ndarray:
        """The queue's tokens given by the end of each window."""
        ends, back = np.unique(np.minimum((number + 1) * window, self.total), return_inverse=True)
        return self.given(ends)[back, queue]


def _webster(m: np.ndarray, give: np.ndarray, size: int) -> np.ndarray:
    """``m`` tokens dealt to queues in proportion to ``give``, so that no queue ever gives a token back as ``m`` grows."""
    have = np.minimum(np.floor(m[:, None] * (give / size) + 0.5).astype(np.int64), give)
    weight = np.where(give > 0, give, 1).astype(float)
    owed = m - have.sum(axis=1)
    while (rows := np.flatnonzero(owed > 0)).size:
        next_up = np.where(have[rows] < give, (2 * have[rows] + 1) / weight, np.inf)
        have[rows, next_up.argmin(axis=1)] += 1
        owed[rows] -= 1
    while (rows := np.flatnonzero(owed < 0)).size:
        last_in = np.where(have[rows] > 0, (2 * have[rows] - 1) / weight, -np.inf)
        # Of equal claims the last queue gives way, as the first is served first.
        have[rows, have.shape[1] - 1 - last_in[:, ::-1].argmax(axis=1)] -= 1
        owed[rows] += 1
    return have


def tokenized(docs: DataFrame, tokenizer_path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """``part, source, doc_id, at, n, ids``: each document's ids, and its place ``at`` in its source's queue of this partition."""
    path = tokenizer_path or default_path()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        part = TaskContext.get().partitionId()
        had: dict[str | None, int] = {}
        for batch in batches:
            sources = batch.column("source").to_pylist()
            for lo, hi, data, offsets in slices(batch.column("text"), 2 << 20):
                found, ends = enc.encode(data, offsets, end_id)
                found, at = found.astype("<u4"), []
                for k in range(hi - lo):
                    at.append(had.get(sources[lo + k], 0))
                    had[sources[lo + k]] = at[-1] + int(ends[k + 1] - ends[k])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(hi - lo, part, np.int32)), batch.column("source").slice(lo, hi - lo), batch.column("doc_id").slice(lo, hi - lo),
                    pa.array(at, pa.int64()), pa.array(np.diff(ends)),
                    pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer((ends * 4).astype(np.int32)), pa.py_buffer(found)]),
                ], names=["part", "source", "doc_id", "at", "n", "ids"])
        del enc
        forget_encoders()

    columns = [F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), "text"]
    return docs.select(*columns).mapInArrow(encode, "part int, source string, doc_id long, at long, n long, ids binary")


def pack(docs: DataFrame, targets: Mapping[str | None, float] | None = None, window: int = WINDOW,
         tokenizer_path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Cut the documents into pieces that fill windows of ``window`` tokens; one row of ``PIECE`` per piece.

    Needs ``doc_id, text, source``; other columns are ignored.  A null or empty text is the end id alone; a null
    source is a source of its own, the last one; repeated rows are packed each.  Sources keep the order of their code
    points, and inside a window they follow each other in that order.  ``targets`` gives each source's share of the
    tokens (default: its share of the corpus, so all queues run out together).  Only the last window is not full.
    An empty table gives no rows.

    The driver holds one total per source: the list of sources is the mixture's own setting, not data that grows.
    """
    small_batches(docs.sparkSession)
    # Written once: the second pass needs the same ids, and a lost executor must not renumber queues.
    stored = computed_once(tokenized(docs, tokenizer_path, end_id), "packing-tokens")
    spent = stored.groupBy("part", "source").agg(F.sum("n").alias("n_part"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # Stored, so that Spark knows its size before it plans the join: a row per partition and source.
    begins = computed_once(
        spent.select(F.col("part").alias("part_"), F.col("source").alias("source_"), F.coalesce(F.sum("n_part").over(earlier), F.lit(0)).alias("begin")), "queue-begins")
    totals = spent.groupBy("source").agg(F.sum("n_part").alias("n")).collect()
    totals.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    names = [r["source"] for r in totals]
    number = {name: k for k, name in enumerate(names)}
    schedule = Schedule(np.array([r["n"] for r in totals], np.int64), None if targets is None else np.array([targets[n] for n in names], float))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                yield _pieces(batch.slice(lo, 2048), number, schedule, window)
            del batch
            give_back()

    joined = stored.join(begins, (F.col("part") == F.col("part_")) & F.col("source").eqNullSafe(F.col("source_"))).select(
        "doc_id", "source", (F.col("at") + F.col("begin")).alias("queued"), "n", "ids",
    )
    return joined.mapInArrow(cut, PIECE)


def _pieces(batch: pa.RecordBatch, number: Mapping[str | None, int], schedule: Schedule, window: int) -> pa.RecordBatch:
    """The pieces of a batch of documents, in the documents' order; their ids are the documents' own bytes, cut at other offsets."""
    first, size = batch.column("queued").to_numpy(), batch.column("n").to_numpy()
    queues = np.array([number[name] for name in batch.column("source").to_pylist()], np.int64)
    found = [_cuts(np.flatnonzero(queues == q), first, size, int(q), schedule, window) for q in np.unique(queues)]
    doc, at, begin, end, offset = (np.concatenate(parts) for parts in zip(*found))
    order = np.lexsort((begin, doc))
    doc, at, begin, end, offset = doc[order], at[order], begin[order], end[order], offset[order]
    _, places, data = batch.column("ids").buffers()
    places = np.frombuffer(places, np.int32, batch.num_rows + 1, batch.column("ids").offset * 4)
    # A document's pieces tile it, so each begins where the one before it ends.
    cuts = np.concatenate((places[:1], places[0] + 4 * np.cumsum(end - begin))).astype(np.int32)
    rows = pa.array(doc)
    return pa.RecordBatch.from_arrays([
        batch.column("doc_id").take(rows), batch.column("source").take(rows), pa.array(begin - first[doc]), pa.array(end - begin),
        pa.array(size[doc]), pa.array(at), pa.array(offset), pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(cuts), data]),
    ], names=["doc_id", "source", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])


def _cuts(rows: np.ndarray, queued: np.ndarray, sizes: np.ndarray, queue: int, schedule: Schedule, window: int) -> tuple[np.ndarray, ...]:
    """Row, window, first and end token in the queue, and offset in the window, of the pieces of one queue's ``rows``."""
    first, size = queued[rows], sizes[rows]
    lo = schedule.window_of(queue, first, window)
    hi = schedule.window_of(queue, first + size - 1, window)
    # A document of a rare source may span more windows than it has tokens: then each token is looked up.
    wide = hi - lo >= size
    doc = np.concatenate((np.repeat(np.flatnonzero(~wide), (hi - lo + 1)[~wide]), np.repeat(np.flatnonzero(wide), size[wide])))
    step = np.concatenate([np.zeros(0, np.int64)] + [np.arange(k) for k in (hi - lo + 1)[~wide]] + [np.arange(k) for k in size[wide]])
    at = np.where(wide[doc], 0, lo[doc] + step)
    tokens = wide[doc]
    if tokens.any():
        at[tokens] = schedule.window_of(queue, first[doc[tokens]] + step[tokens], window)
        keep = np.ones(len(doc), bool)
        keep[1:] = ~(tokens[1:] & (doc[1:] == doc[:-1]) & (at[1:] == at[:-1]))
        doc, at = doc[keep], at[keep]
    where, back = np.unique(at, return_inverse=True)
    edges = np.unique(np.concatenate((where, where + 1)))
    given = schedule.given(np.minimum(edges * window, schedule.total))
    before = given[np.searchsorted(edges, where)]
    after = given[np.searchsorted(edges, where + 1)]
    ahead = (after - before)[:, :queue].sum(axis=1)
    begin = np.maximum(first[doc], before[back, queue])
    end = np.minimum(first[doc] + size[doc], after[back, queue])
    kept = end > begin
    doc, at, begin, end, back = doc[kept], at[kept], begin[kept], end[kept], back[kept]
    return rows[doc], at, begin, end, ahead[back] + begin - before[back, queue]


def sequences(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """The packed windows: ``sequence_id, n_tokens, ids``; a group is at most ``window`` tokens."""
    held = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"), F.array_join(F.transform(held, lambda p: F.hex(p["ids"])), "").alias("hex"),
    ).select("sequence_id", "n_tokens", F.unhex("hex").alias("ids"))
