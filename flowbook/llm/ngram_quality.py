"""Quality rules: base statistics of every text, and a length-normalised log-likelihood ratio of n-grams.

Every word and word pair has its own counts, by its 64-bit hash.  The most frequent ones, of a fixed number, are
counted in place in each task and their ratios broadcast; all others are dealt by hash and counted there.  The target multinomial is counted over one half of
the trusted documents (by hash of ``doc_id``), the raw one over the whole corpus.  The other half of the trusted
documents and the labelled rejects set the threshold, so that it holds for documents the target has not seen.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import computed_once
from .flat import mix, packed, rolling, slices, small_batches, span_hashes, unpacked, word_hashes

# Frequent n-grams have a place by the first bits of their hash; an n-gram that a chunk of a task has less often is none.
_SLOT_BITS, WAYS = 19, 2
SLOTS = 1 << _SLOT_BITS
CHUNK_GRAMS, OFTEN = 1 << 22, 4
# Other n-grams leave a task by so many at a time and are counted in parts of about so many; beside the part's number so
# many bits of the hash tell them apart.
DEAL_GRAMS, DEAL_TEXTS, PART_GRAMS, PART_BITS = 1 << 19, 1 << 15, 1 << 21, 38
FEW_IDS = 1 << 20
SLICE = 1 << 20
POINTS = 1 << 28
PSEUDO = 2.0
KEEP_TRUSTED = 0.995
STEP, RANGE = 0.0005, 4.0
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5

_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[list(b"#*$%&|<>")] = 1
_STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def _per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _repeated(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each item equals an earlier one of its owner, and whether it equals any other."""
    order = np.lexsort((hashes, owner))
    same = (hashes[order][1:] == hashes[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    later, both = np.zeros(len(order), bool), np.zeros(len(order), bool)
    later[order[1:]] = same
    both[order[1:]] |= same
    both[order[:-1]] |= same
    return later, both


def base_statistics(data: np.ndarray, offsets: np.ndarray, words: tuple[np.ndarray, ...]) -> dict[str, np.ndarray]:
    """The statistics of consecutive texts; ``words`` is what ``word_hashes`` gives for them."""
    hashes, first, _, owner = words
    texts = len(offsets) - 1
    spaces = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    out = {
        "n_words": np.bincount(owner, minlength=texts).astype(np.int64),
        "word_chars": _per_text(((data & 0xC0) != 0x80) & ~spaces, offsets),
        "n_symbols": _per_text(_SYMBOL[data], offsets),
    }
    breaks = np.flatnonzero(data == 0x0A)
    starts = np.unique(np.concatenate((offsets[:-1], breaks + 1)))
    starts = starts[starts < len(data)] if len(data) else starts[:0]
    stops = np.concatenate((starts[1:], [len(data)])) if len(starts) else starts
    ends = stops - ((data[stops - 1] == 0x0A) if len(starts) else 0)
    had = np.searchsorted(first, ends, "left") - np.searchsorted(first, starts, "left") > 0
    starts, ends = starts[had], ends[had]
    line_owner = np.searchsorted(offsets, starts, "right") - 1
    later, _ = _repeated(line_owner, span_hashes(data, starts, ends))
    out["n_dup_lines"] = np.bincount(line_owner[later], minlength=texts).astype(np.int64)
    grams = rolling(hashes, WINDOW, 5)
    inside = np.flatnonzero(owner[:len(grams)] == owner[WINDOW - 1:]) if len(grams) else np.zeros(0, np.int64)
    _, twice = _repeated(owner[inside], grams[inside])
    cover = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(cover, inside[twice], 1)
    np.add.at(cover, inside[twice] + WINDOW, -1)
    out["n_repeat_words"] = np.bincount(owner[np.cumsum(cover[:-1]) > 0], minlength=texts).astype(np.int64)
    return out


def grams_of(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash and text number of every word, then of every pair of neighbouring words."""
    pairs = np.flatnonzero(owner[:-1] == owner[1:])
    both = mix(hashes[pairs] * np.uint64(0x9FB21C651E98DF25) + hashes[pairs + 1])
    return np.concatenate((mix(hashes), both)), np.concatenate((owner, owner[pairs]))


def no_keys() -> np.ndarray:
    """A table of frequent n-grams without any: each place holds a value that belongs to another slot."""
    return np.tile((np.arange(SLOTS, dtype=np.uint64) ^ np.uint64(1)) << np.uint64(64 - _SLOT_BITS), WAYS)


def places_of(grams: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The place of each n-gram in the table of frequent ones, or -1."""
    slot = (grams >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
    place = np.full(len(grams), -1, np.int64)
    for way in range(WAYS):
        at = slot + way * SLOTS
        place = np.where(keys[at] == grams, at, place)
    return place


def frequent(docs: DataFrame) -> np.ndarray:
    """The most frequent n-grams of each slot of hashes, at most ``WAYS`` each.

    They only say which n-grams are counted in place and which are dealt by hash (they are the ones that would fill one
    task); no score depends on the choice.
    """
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def often() -> Iterator[pa.RecordBatch]:
            grams = np.concatenate(held)
            held.clear()
            grams.sort()  # in place: a chunk is the largest array of the task
            at = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]]) if len(grams) else np.zeros(0, np.int64)
            many = np.diff(np.r_[at, len(grams)])
            grams, many = grams[at[many >= OFTEN]].view(np.int64), many[many >= OFTEN]
            for lo in range(0, len(grams), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(grams[lo:lo + (1 << 16)]), pa.array(many[lo:lo + (1 << 16)])], names=["gram", "many"])

        for batch in batches:
            for _, _, data, offsets in slices(batch.column("text"), SLICE):
                hashes, _, _, owner = word_hashes(data, offsets)
                held.append(grams_of(hashes, owner)[0])
                size += len(held[-1])
                if size >= CHUNK_GRAMS:
                    yield from often()
                    held, size = [], 0
        if held:
            yield from often()

    found = docs.select("text").mapInArrow(find, "gram long, many long").groupBy("gram").agg(F.sum("many").alias("many"))
    slot = F.shiftrightunsigned("gram", 64 - _SLOT_BITS)
    first = Window.partitionBy("slot").orderBy(F.desc("many"), "gram")
    rows = found.withColumn("slot", slot).withColumn("way", F.row_number().over(first)).where(F.col("way") <= WAYS).select("gram", "slot", F.col("way").cast("long").alias("way")).toArrow()
    gram, slot, way = (rows.column(c).to_numpy() for c in ("gram", "slot", "way"))
    keys = no_keys()
    keys[slot + (way - 1) * SLOTS] = gram.view(np.uint64)
    return keys


def marked(docs: DataFrame, target: DataFrame) -> DataFrame:
    """``ref, text, in_target``: whether the ``doc_id`` is in ``target``.  A list of ids that fits is broadcast, so that texts stay where they are."""
    ids = target.select(F.col("doc_id").alias("_id")).distinct().withColumn("_in", F.lit(True))
    if ids.limit(FEW_IDS + 1).count() <= FEW_IDS:
        ids = F.broadcast(ids)
    joined = docs.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("_id"), "left")
    return joined.select(_ref().alias("ref"), "text", F.col("_in").alias("in_target"))


def _ref() -> Column:
    return F.xxhash64(F.col("doc_id").cast("long"), "text")


def counted(docs: DataFrame, target: DataFrame, keys: np.ndarray | None = None) -> DataFrame:
    """``place, raw, target``: counts of the n-grams in ``keys`` over all documents and over those in ``target``; place -1 is all others together."""
    shared = docs.sparkSession.sparkContext.broadcast(no_keys() if keys is None else keys)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = len(shared.value)
        raw, good = np.zeros(places + 1, np.int64), np.zeros(places + 1, np.int64)
        for batch in batches:
            trusted = batch.column("in_target").is_valid().to_numpy(zero_copy_only=False)
            for lo, hi, data, offsets in slices(batch.column("text"), SLICE):
                hashes, _, _, owner = word_hashes(data, offsets)
                grams, owner = grams_of(hashes, owner)
                place = places_of(grams, shared.value) + 1
                raw += np.bincount(place, minlength=places + 1)
                good += np.bincount(place[trusted[lo:hi][owner]], minlength=places + 1)
        seen = np.flatnonzero(raw)
        for lo in range(0, len(seen), 1 << 16):
            part = seen[lo:lo + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part - 1), pa.array(raw[part]), pa.array(good[part])], names=["place", "raw", "target"])

    parts = marked(docs, target).mapInArrow(count, "place long, raw long, target long")
    return parts.groupBy("place").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(raw: np.ndarray, target: np.ndarray, all_raw: int, all_target: int) -> np.ndarray:
    """The log ratio of each n-gram in whole ``1 / POINTS``, so that sums do not depend on their order.

    Both multinomials get ``PSEUDO`` counts on the target's scale, so an n-gram with little evidence is near 0.
    """
    if not all_target:
        return np.zeros(len(raw), np.int64)
    return np.rint(np.log((target + PSEUDO) / (raw * (all_target / all_raw) + PSEUDO)) * POINTS).astype(np.int64)


def rare_points(docs: DataFrame, target: DataFrame, keys: np.ndarray, rare: int, totals: tuple[int, int]) -> DataFrame:
    """``ref, points``: the summed log ratios of the n-grams outside ``keys``, of all rows of one ``ref`` together.

    A chunk of texts sends its n-grams, sorted by hash, to parts of about ``PART_GRAMS``: the steps between hashes and
    the text's number in the chunk.  A part counts each of its n-grams over the whole corpus and sends one sum per text
    back to the chunk, which adds them up.
    """
    shared = docs.sparkSession.sparkContext.broadcast(keys)
    parts = max(1, -(-rare // PART_GRAMS))
    drop = np.uint64(max(0, 64 - PART_BITS - parts.bit_length()))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        refs, grams, texts, size, count = [], [], [], 0, 0

        def sent() -> pa.RecordBatch:
            # The lowest bit of a text's number says whether it is in the target.
            hashes, numbers = np.concatenate(grams), np.concatenate(texts)
            order = np.argsort(hashes)
            hashes, numbers = hashes[order], numbers[order]
            part = ((hashes >> np.uint64(40)) * np.uint64(parts) >> np.uint64(24)).astype(np.int64)
            steps = (hashes >> drop).view(np.int64)
            head = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else part
            rows = [
                (int(part[a]), chunk, packed(np.diff(steps[a:b], prepend=0), numbers[a:b]), None) for a, b in zip(head.tolist(), np.r_[head[1:], len(part)].tolist())
            ]
            rows.append((chunk % parts, chunk, None, np.concatenate(refs).tobytes()))
            types = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["part", "chunk", "grams", "refs"])

        for batch in batches:
            trusted = batch.column("in_target").is_valid().to_numpy(zero_copy_only=False)
            own = batch.column("ref").to_numpy()
            for lo, hi, data, offsets in slices(batch.column("text"), SLICE):
                hashes, _, _, owner = word_hashes(data, offsets)
                found, owner = grams_of(hashes, owner)
                other = places_of(found, shared.value) < 0
                grams.append(found[other])
                texts.append((count + owner[other]) * 2 + trusted[lo:hi][owner[other]])
                refs.append(own[lo:hi])
                size, count = size + len(grams[-1]), count + hi - lo
                if size >= DEAL_GRAMS or count >= DEAL_TEXTS:
                    yield sent()
                    refs, grams, texts, size, count, chunk = [], [], [], 0, 0, chunk + 1
        if count:
            yield sent()

    def count(table: pa.Table) -> pa.Table:
        held = [(c, *unpacked(g, 2)) for c, g in zip(table.column("chunk").to_pylist(), table.column("grams").to_pylist()) if g is not None]
        rows = [(c, None, r) for c, r in zip(table.column("chunk").to_pylist(), table.column("refs").to_pylist()) if r is not None]
        if held:
            _, which, raw = np.unique(np.concatenate([np.cumsum(steps) for _, steps, _ in held]), return_inverse=True, return_counts=True)
            numbers = np.concatenate([n for _, _, n in held])
            ratios = log_ratios(raw, np.bincount(which[numbers & 1 == 1], minlength=len(raw)), *totals)[which]
            at = 0
            for chunk, _, own in held:
                order = np.argsort(own, kind="stable")
                first = np.flatnonzero(np.r_[True, own[order][1:] != own[order][:-1]])
                points = np.add.reduceat(ratios[at:at + len(own)][order], first)
                rows.append((chunk, packed(np.diff(own[order][first] >> 1, prepend=0), points), None))
                at += len(own)
        types = (pa.int64(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["chunk", "points", "refs"])

    def add(table: pa.Table) -> pa.Table:
        refs = np.frombuffer(next(r for r in table.column("refs").to_pylist() if r is not None), np.int64)
        points = np.zeros(len(refs), np.int64)
        for block in table.column("points").to_pylist():
            if block is not None:
                steps, more = unpacked(block, 2)
                points[np.cumsum(steps)] += more
        return pa.table({"ref": refs, "points": points})

    dealt = marked(docs, target).mapInArrow(deal, "part long, chunk long, grams binary, refs binary")
    back = dealt.groupBy("part").applyInArrow(count, "chunk long, points binary, refs binary")
    return back.groupBy("chunk").applyInArrow(add, "ref long, points long").groupBy("ref").agg(F.sum("points").alias("points"))


def threshold(scores: DataFrame, labelled: DataFrame) -> float:
    """The score below which documents go, from labelled documents outside the target (``doc_id, trusted``).

    Of all thresholds that keep ``KEEP_TRUSTED`` of the trusted documents, the one that separates them best from the
    rejects; at equal separation the lowest.  Scores are counted in bins, so the driver gets a fixed number of rows.
    """
    place = F.floor(F.least(F.greatest(F.col("score"), F.lit(-RANGE)), F.lit(RANGE)) / STEP)
    bins = scores.where("score IS NOT NULL").join(labelled.select(F.col("doc_id").alias("_id"), "trusted"), F.col("doc_id") == F.col("_id")).groupBy(
        place.alias("bin"),
    ).agg(F.sum(F.col("trusted").cast("long")).alias("good"), F.count("*").alias("all")).toPandas().sort_values("bin")
    good, bad = bins["good"].to_numpy(), (bins["all"] - bins["good"]).to_numpy()
    if not len(bins) or not good.sum() or not bad.sum():
        return float("-inf")
    # Threshold k drops the bins before bin k.
    lost = np.concatenate(([0], np.cumsum(good)[:-1])) / good.sum()
    caught = np.concatenate(([0], np.cumsum(bad)[:-1])) / bad.sum()
    gain = np.where(lost <= 1 - KEEP_TRUSTED, caught - lost, -1.0)
    best = int(gain.argmax())
    return float(bins["bin"].iloc[best]) * STEP if gain[best] > 0 else float("-inf")


def score(docs: DataFrame, target: DataFrame) -> DataFrame:
    """Every document with its statistics and mean log ratio (null without words); ``doc_id`` and ``_h`` in front."""
    keys = frequent(docs)
    rows = counted(docs, target, keys).toArrow()  # at most one row per place, whatever the corpus
    place, raw, good = (rows.column(c).to_numpy() for c in ("place", "raw", "target"))
    totals = int(raw.sum()), int(good.sum())
    weights = np.zeros(len(keys) + 1, np.int64)  # the last one is for place -1
    weights[place[place >= 0]] = log_ratios(raw, good, *totals)[place >= 0]
    shared = docs.sparkSession.sparkContext.broadcast((keys, weights))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, weights = shared.value
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column("text"), SLICE):
                words = word_hashes(data, offsets)
                stats = base_statistics(data, offsets, words)
                grams, owner = grams_of(words[0], words[3])
                points = np.zeros(hi - lo, np.int64)
                np.add.at(points, owner, weights[places_of(grams, keys)])
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).slice(lo, hi - lo) for c in ("doc_id", "_h", "ref")], *[pa.array(v) for v in stats.values()], pa.array(points)],
                    names=["doc_id", "_h", "ref", *stats, "points"],
                )

    lean = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_h"), _ref().alias("ref"))
    stats = computed_once(lean.mapInArrow(measure, f"doc_id long, _h long, ref long, {_STATS}, points long"), "quality-statistics")
    rare = int(raw[place < 0].sum()) if totals[1] else 0
    if rare:
        # Rows with equal id and text have equal sums.
        copies = stats.groupBy("ref").agg(F.count("*").alias("copies"))
        own = rare_points(docs, target, keys, rare, totals).join(copies, "ref").select("ref", F.expr("points div copies").alias("rare"))
        stats = stats.join(own, "ref", "left")
    else:
        stats = stats.withColumn("rare", F.lit(0))
    total = (F.col("points") + F.coalesce("rare", F.lit(0))).cast("double") / POINTS
    mean = F.when(F.col("n_words") > 0, total / (2 * F.col("n_words") - 1))
    return stats.withColumn("score", mean).drop("ref", "points", "rare")


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, threshold, kept`` per document.

    Needs ``doc_id, text`` of documents and ``doc_id, quality, toxic`` of labels; other columns are ignored.  Trusted
    are documents with a label of quality 1 and not toxic; other labelled ones are rejects; labels with a null count
    for nothing.  A null or empty text has no words and fails the base rules.  Repeated rows are judged each.  Without
    labels of both kinds nothing is dropped beyond the base rules.  ``_h`` is a hash of the text, to tell rows with one
    ``doc_id`` apart.
    """
    small_batches(docs.sparkSession)
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(
        F.min(((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int")).cast("boolean").alias("trusted"),
    ).withColumn("fit", F.col("trusted") & (F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0))
    scores = computed_once(score(docs, known.where("fit").select("doc_id")), "quality-scores")
    limit = threshold(scores, known.where("NOT fit").select("doc_id", "trusted"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return scores.withColumn("base_failed", failed).withColumn("threshold", F.lit(limit)).withColumn(
        "kept", ~F.col("base_failed") & F.coalesce(F.col("score") >= F.col("threshold"), F.lit(False)),
    )
