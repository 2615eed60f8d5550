"""Removal of repeated byte strings by merging Burrows-Wheeler transforms.

Every string of ``WINDOW`` bytes belongs to an anchor: the least of its hashed ``GRAM``-byte parts.  Spark finds the
anchors that documents share (see ``repeats``), and the contexts around them, each different one once, go to the
transforms.  Contexts are dealt to buckets by anchor.  Inside a bucket each shard of contexts gets its own sorted
suffixes and transform; the transforms are merged by refining their interleave: in step ``k`` the interleave, which
is right for the first ``k - 1`` characters, is sorted stably by the character before each suffix and so is right for
``k``, without sorting suffixes anew.  Places that no step has parted after ``WINDOW`` steps have that common
prefix: they are the repeated intervals, and the smallest document of each interval keeps its string.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import computed_once, working_folder
from .flat import mix, powers, range_hashes, slices, small_batches, texts_of
from .repeats import covered, keyed, once_per_text, packed_names, passes, segments, shared_filter, with_spans

WINDOW = 50
GRAM = 20
CHUNK_MARKS = 32
# A bucket's contexts make so many shards at least; the merge alone decides what two shards share.
SHARD_BYTES, SHARDS = 1 << 17, 4
LOT_ROWS = 20_000
# Small enough that the arrays over a slice stay in a core's cache.
SLICE = 1 << 17
BUCKET_ROWS = 4_000
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_END = 0


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of ``text`` in the order of their first ``depth`` symbols at least (ends are smaller and all different)."""
    ends = text == _END
    # Seven symbols in one number first; behind an end everything is 0, and ends are told apart by their place.
    symbols = text.astype(np.int64)
    rank, open_ = symbols << 56 - 8, ~ends
    for k in range(1, 7):
        rank[:-k] |= np.where(open_[:-k], symbols[k:], 0) << 48 - 8 * k
        open_[:-k] &= ~ends[k:]
        open_[-k:] = False
    order, have = np.argsort(rank), 7
    placed = rank[order]
    new = np.r_[False, placed[1:] != placed[:-1]]
    # The number of a suffix's end: equal numbers that hold an end are different strings.
    which = np.cumsum(ends) - ends
    length = _to_end(ends)
    short = length[order] < have
    if short.any():
        order = np.lexsort((np.where(length < have, which, 0), rank))
        placed, many = rank[order], np.where(length < have, which + 1, 0)[order]
        new = np.r_[False, (placed[1:] != placed[:-1]) | (many[1:] != many[:-1])]
    rank = np.empty(len(text), np.int64)
    rank[order] = np.cumsum(new)
    while have < depth and int(rank.max()) < len(text) - 1:
        key = rank * np.int64(len(text) + 1)
        key[:-have] += rank[have:] + 1
        order = np.argsort(key)
        placed = key[order]
        rank[order] = np.cumsum(np.r_[False, placed[1:] != placed[:-1]])
        have *= 2
    return order


def _to_end(ends: np.ndarray) -> np.ndarray:
    """How many symbols stand before the next end, for each place (0 at an end)."""
    at = np.flatnonzero(ends)
    places = np.arange(len(ends))
    return at[np.searchsorted(at, places)] - places if len(at) else places[::-1] + 1


def _before(text: np.ndarray, order: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` symbols before each suffix, as one number; before a string's first symbol stands its end."""
    ends = np.flatnonzero(text == _END)
    size = np.diff(np.r_[-1, ends])
    start, length = np.repeat(ends + 1 - size, size), np.repeat(size, size)
    place = np.arange(len(text)) - start
    out = np.zeros(len(text), np.int64)
    for k in range(count, 0, -1):
        out = out << 8 * (text.dtype.itemsize if count > 1 else 1) | text[start + (place - k) % length]
    return out[order]


def merged_blocks(shards: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shard and place in its text of every suffix in merged order, and the block of suffixes with ``depth`` common symbols.

    Shards are strings, each closed by an end.  No suffix is compared with another: a step deals the suffixes, as they lie,
    by the symbols before them, which each shard's transform gives in its own order.  Steps take two symbols at once,
    so that 25 of them make 50; the last one takes a single symbol where ``depth`` is odd.
    """
    wide = max(int(s.max(initial=0)) for s in shards) > 255
    shards = [s.astype(np.uint16 if wide else np.uint8) for s in shards]
    orders = [suffix_order(s, 2 * depth) for s in shards]
    steps = [1] * depth if wide else [2] * (depth // 2) + [1] * (depth % 2)
    transforms = {n: [_before(s, o, n).astype(np.uint16) for s, o in zip(shards, orders)] for n in set(steps)}
    z = np.repeat(np.arange(len(shards), dtype=np.uint8 if len(shards) <= 256 else np.uint16), [len(s) for s in shards])
    # Ends are all different, in the order of their strings: their shards, and the shards of last symbols followed by an end.
    end_shard = np.concatenate([np.full(int((s == _END).sum()), k, z.dtype) for k, s in enumerate(shards)])
    lasts = np.concatenate([np.r_[s[:1], s[:-1]][s == _END] for s in shards])
    last_shard = end_shard[np.argsort(lasts, kind="stable")]
    total = len(end_shard)
    block = np.zeros(len(z), np.int32)
    before = np.empty(len(z), np.uint16)
    new = np.zeros(len(z), bool)
    transforms = {n: np.concatenate(own) for n, own in transforms.items()}
    for n in steps:
        # The places of one shard after the other, each in its own order, as the transforms stand.
        before[np.argsort(z, kind="stable")] = transforms[n]
        order = np.argsort(before, kind="stable")
        char, block, z = before[order], block[order], z[order]
        z[:total] = end_shard
        np.not_equal(char[1:], char[:-1], out=new[1:])
        new[1:] |= block[1:] != block[:-1]
        new[1:total + 1] = True
        if n == 2:
            closed = np.flatnonzero(char[total:] & 0xFF == _END) + total
            z[closed] = last_shard
            new[closed] = True
            new[np.minimum(closed + 1, len(new) - 1)] = True
        block = np.cumsum(new, dtype=np.int32)
    place = np.empty(len(z), np.int64)
    for k, own in enumerate(orders):
        place[z == k] = own
    return z, place, block


def _repeated(group: pd.DataFrame, window: int) -> pd.DataFrame:
    """``name, cd, i, m``: windows that occur in another context of a smaller document."""
    contents, docs = group["content"].tolist(), group["d0"].to_numpy(np.int64)
    part = group["part"].to_numpy()
    sizes = np.fromiter(map(len, contents), np.int64, len(contents)) + 1
    limit = min(SHARD_BYTES, max(1, int(sizes.sum()) // SHARDS))
    shards, rows = [], []
    for value in np.unique(part):
        mine = np.flatnonzero(part == value)
        # A shard ends with the context that fills it.
        number = (np.cumsum(sizes[mine]) - sizes[mine]) // limit
        for which in np.split(mine, np.flatnonzero(np.diff(number)) + 1):
            text = np.zeros(int(sizes[which].sum()), np.uint16)
            inside = np.ones(len(text), bool)
            inside[np.cumsum(sizes[which]) - 1] = False
            text[inside] = np.frombuffer(b"".join([contents[k] for k in which.tolist()]), np.uint8).astype(np.uint16) + 1
            shards.append(text), rows.append(which)
    begins = [np.cumsum(sizes[which]) - sizes[which] for which in rows]
    z, place, block = merged_blocks(shards, window)
    owner, at = np.empty(len(z), np.int64), np.empty(len(z), np.int64)
    for s in range(len(shards)):
        here = np.flatnonzero(z == s)
        k = np.searchsorted(begins[s], place[here], "right") - 1
        owner[here], at[here] = rows[s][k], place[here] - begins[s][k]
    whole = at + window < sizes[owner]
    owner, at, block = owner[whole], at[whole], block[whole]
    starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]]) if len(block) else np.zeros(0, np.int64)
    least = np.minimum.reduceat(docs[owner], starts) if len(starts) else docs[:0]
    least = np.repeat(least, np.diff(np.r_[starts, len(block)]))
    hit = np.flatnonzero(docs[owner] > least)
    order = hit[np.lexsort((at[hit], owner[hit]))]
    o, a = owner[order], at[order]
    cut = np.flatnonzero(np.r_[True, (o[1:] != o[:-1]) | (a[1:] != a[:-1] + 1)]) if len(o) else np.zeros(0, np.int64)
    return pd.DataFrame({
        "name": group["name"].to_numpy(np.int64)[o[cut]], "cd": group["cd"].to_numpy(np.int64)[o[cut]],
        "i": a[cut].astype(np.int64), "m": np.diff(np.r_[cut, len(o)]).astype(np.int64),
    })


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of every ``gram`` consecutive bytes, from prefix sums of a polynomial."""
    size = 1 << len(data).bit_length()
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_CODES[data] * powers(_BASE, size)[:len(data)], out=sums[1:])
    return mix((sums[gram:] - sums[:-gram]) * powers(_INVERSE, size)[:len(data) - gram + 1])


def marks_of(data: np.ndarray, offsets: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Name, first window, number of windows and text of each mark: runs of windows with one least gram (the last of equal ones)."""
    gram = min(GRAM, window)
    windows = len(data) - window + 1
    none = np.zeros(0, np.int64)
    if windows <= 0:
        return none.view(np.uint64), none, none, none
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    inside = np.where(text[:windows] == text[window - 1:], text[:windows], -1)
    grams = _gram_hashes(data, gram)
    wide = window - gram + 1
    # The least gram of each window and where it is, by doubling: half a hash and the place in one number, so that the
    # last of equal ones is the least.
    least = (grams & np.uint64(0xFFFFFFFF00000000)) | (np.uint64(0xFFFFFFFF) - np.arange(len(grams), dtype=np.uint64))
    have = 1
    while 2 * have <= wide:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    rest = wide - have
    at = (np.uint64(0xFFFFFFFF) - (np.minimum(least[:windows], least[rest:rest + windows]) & np.uint64(0xFFFFFFFF))).astype(np.int64)
    start, size = segments(at, inside)
    return mix(grams[at[start]]), start, size, text[start]


def _chunks(window: int):
    """A task that cuts texts into chunks of about ``CHUNK_MARKS`` marks, at marks whose names say so, with a digest of each."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs_, ths = batch.column("doc").to_numpy(), batch.column("th").to_numpy()
            for lo, _, data, offsets in slices(batch.column("text"), SLICE):
                name, where, many, text = marks_of(data, offsets, window)
                begins = (name % np.uint64(CHUNK_MARKS) == 0) | np.r_[True, text[1:] != text[:-1]] if len(name) else np.zeros(0, bool)
                start, of = where[begins], text[begins]
                n = np.add.reduceat(many, np.flatnonzero(begins)) if len(start) else start
                raw = data.tobytes()
                digests = b"".join(hashlib.blake2b(raw[a:a + k + window - 1], digest_size=16).digest() for a, k in zip(start.tolist(), n.tolist()))
                key = np.frombuffer(digests, np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([
                    pa.array(key[:, 0]), pa.array(key[:, 1]), pa.array(docs_[lo + of]), pa.array(ths[lo + of]), pa.array(start - offsets[of]), pa.array(n.astype(np.int64)),
                ], names=["c1", "c2", "doc", "th", "p", "n"])

    return cut


def _inside(where: np.ndarray, offsets: np.ndarray, spans: list[list[dict] | None]) -> np.ndarray:
    """Which marks lie in a settled chunk; chunks begin at marks, so a mark lies in one whole or not at all."""
    found = [(offsets[k] + s["p"], s["n"]) for k, runs in enumerate(spans) for s in runs or ()]
    if not found or not len(where):
        return np.zeros(len(where), bool)
    begin, size = np.array(sorted(found), np.int64).T
    k = np.searchsorted(begin, where, "right") - 1
    return (k >= 0) & (where < begin[k] + size[k])


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, th, n_bytes, n_removed, n_spans, kept`` per document; ``kept`` is the rest of its UTF-8 bytes.

    Needs ``doc_id, text``; other columns are ignored.  A byte goes if a string of ``window`` bytes that covers it also
    starts in a document with a smaller ``doc_id``, judged on the input; matches never cross documents.  A null or
    empty text, and one shorter than the window, stays as it is.  A document with a null ``doc_id`` has no place in
    the order: it is kept whole and removes nothing.  Rows with one ``doc_id`` are not compared with each other; each
    gets its own result.  An empty table gives no rows.  What is kept of a text need not be valid UTF-8.
    """
    spark = docs.sparkSession
    small_batches(spark)
    # Long equal stretches are settled whole first: every window in one is covered by the smallest document that has it,
    # so their places in later documents need no marks.
    chunks = computed_once(keyed(docs).where("doc IS NOT NULL").mapInArrow(_chunks(window), "c1 long, c2 long, doc long, th long, p long, n long"), "chunks")
    first = chunks.groupBy(F.col("c1").alias("d1"), F.col("c2").alias("d2")).agg(F.min("doc").alias("d0"), F.max("doc").alias("last")).where("d0 < last")
    long_runs = computed_once(
        chunks.join(first, (F.col("c1") == F.col("d1")) & (F.col("c2") == F.col("d2")) & (F.col("doc") > F.col("d0"))).select("doc", "th", "p", "n"), "long-runs")
    texts = with_spans(keyed(docs), long_runs)
    folder = working_folder(spark, "settled-texts")
    texts.write.mode("overwrite").option("compression", "zstd").parquet(folder)
    texts = spark.read.schema(texts.schema).parquet(folder)
    live = texts.where("doc IS NOT NULL")

    def name_marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def names() -> Iterator[np.ndarray]:
            for batch in batches:
                spans = batch.column("spans").to_pylist()
                for lo, hi, data, offsets in slices(batch.column("text"), SLICE):
                    name, where, _, text = marks_of(data, offsets, window)
                    new = ~_inside(where, offsets, spans[lo:hi])
                    yield once_per_text(name[new], text[new])

        return packed_names(names())

    shared = spark.sparkContext.broadcast(shared_filter(live.select("text", "spans").mapInArrow(name_marks, "part int, names binary")))

    def found(batch: pa.RecordBatch, bits: np.ndarray):
        """The marks of a batch that pass a filter, slice by slice, with a digest of their bytes."""
        spans = batch.column("spans").to_pylist()
        for lo, hi, data, offsets in slices(batch.column("text"), SLICE):
            name, where, many, text = marks_of(data, offsets, window)
            kept = passes(bits, name) & ~_inside(where, offsets, spans[lo:hi])
            name, where, many, text = name[kept], where[kept], many[kept], text[kept]
            digest = range_hashes(_CODES[data], where, where + many + window - 1).view(np.int64)
            yield name.view(np.int64), digest, where, many.astype(np.int64), lo + text, where - offsets[text], data

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs_, ths = batch.column("doc").to_numpy(), batch.column("th").to_numpy()
            for name, digest, _, many, row, p, _ in found(batch, shared.value):
                columns = [name, digest, docs_[row], ths[row], p, many]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["name", "cd", "doc", "th", "p", "n"])

    marks = computed_once(live.mapInArrow(emit, "name long, cd long, doc long, th long, p long, n long"), "marks")

    def contents_of(bits: np.ndarray) -> DataFrame:
        wanted = spark.sparkContext.broadcast(bits)

        def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                docs_ = batch.column("doc").to_numpy()
                for name, digest, where, many, row, _, data in found(batch, wanted.value & shared.value):
                    # Equal contexts of one document are sent once.
                    order = np.lexsort((docs_[row], digest, name))
                    a, b, c = name[order], digest[order], docs_[row][order]
                    first = order[np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (c[1:] != c[:-1])]] if len(order) else order
                    raw = data.tobytes()
                    texts = pa.array([raw[a:a + n + window - 1] for a, n in zip(where[first].tolist(), many[first].tolist())], pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(name[first]), pa.array(digest[first]), pa.array(docs_[row][first]), texts], names=["name", "cd", "doc", "content"])

        return live.mapInArrow(contents, "name long, cd long, doc long, content binary")

    def look(contents: DataFrame) -> DataFrame:
        contents = computed_once(contents, "contexts")
        # Buckets of about BUCKET_ROWS contexts; a bucket that one anchor fills is cut into lots that are merged two by two.
        rows = contents.count()
        buckets = max(1, -(-rows // BUCKET_ROWS))
        dealt = contents.withColumn("bucket", F.pmod(F.xxhash64("name"), F.lit(buckets)))
        lots = dealt.groupBy("bucket").agg(F.ceil(F.count("*") / LOT_ROWS).cast("int").alias("lots")).select(F.col("bucket").alias("b_"), "lots")
        dealt = dealt.join(lots, F.col("bucket") == F.col("b_")).withColumn("part", F.pmod("cd", F.col("lots")).cast("int")).withColumn(
            "other", F.explode(F.sequence(F.lit(0), F.col("lots") - 1)),
        )
        pairs = dealt.select("bucket", F.least("part", "other").alias("bi"), F.greatest("part", "other").alias("bj"), "part", "name", "cd", "content", "d0")
        return pairs.groupBy("bucket", "bi", "bj").applyInPandas(lambda g: _repeated(g, window), "name long, cd long, i long, m long")

    joined = with_spans(texts.withColumnRenamed("spans", "long_runs"), covered(marks, look, contents_of))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [(a or []) + (b or []) for a, b in zip(batch.column("spans").to_pylist(), batch.column("long_runs").to_pylist())]
            data, offsets = texts_of(batch.column("text"))
            sizes, removed, runs, kept = [], [], [], []
            for k in range(batch.num_rows):
                raw = data[offsets[k]:offsets[k + 1]]
                gone = np.zeros(len(raw) + 1, np.int64)
                for s in spans[k]:
                    gone[s["p"]] += 1
                    gone[s["p"] + s["n"] + window - 1] -= 1
                stay = np.cumsum(gone[:-1]) == 0
                sizes.append(len(raw))
                removed.append(int((~stay).sum()))
                runs.append(int(np.count_nonzero(np.diff(np.r_[1, stay.astype(np.int8)]) == -1)))
                kept.append(raw[stay].tobytes())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc"), batch.column("th"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary()),
            ], names=["doc_id", "th", "n_bytes", "n_removed", "n_spans", "kept"])

    return joined.mapInArrow(cut, "doc_id long, th long, n_bytes long, n_removed long, n_spans long, kept binary")
