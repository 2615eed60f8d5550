"""N-gram Jaccard join by chosen paths.

A text is its set of five-word shingles, sketched by ``T`` min-hash values.  Sets are split recursively on sampled
shared values: a node samples ``BRANCH`` coordinates, and a set goes on to one child per coordinate, named by its
value there, so similar sets stay together with the probability of their similarity.  Small nodes are compared by
brute force.  A node that splitting cannot make smaller, because its sets are near copies of each other, is compared
by brute force too, in blocks, so no bucket is capped.  Runs with fresh coordinates repeat until the target recall.

A pair can meet in several leaves; it is counted only in the smallest leaf that its two texts share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import computed_once
from .components import components
from .flat import mix, rolling, slices, small_batches, word_hashes
from .repeats import name_filter, passes

SHINGLE, SIMILARITY = 5, 0.8
T = 128
BRANCH = 3
SMALL = 64
DEPTH = 6
ALIKE = 0.4
BLOCK = 1024
RECALL = 0.9999
SKETCH_CUT = 0.65

_A = (mix(np.arange(1, T + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_B = (mix(np.arange(1, T + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) >> np.uint64(32)).astype(np.uint32)


def run_recall(shared: float = 0.7, branch: int = BRANCH, depth: int = DEPTH) -> float:
    """The chance that one run brings a pair to a common leaf if it shares this part of its sketch."""
    q = 1.0
    for _ in range(depth):
        q = 1 - (1 - shared * q) ** branch
    return q


def runs_for(recall: float) -> int:
    """Runs until the target recall; 0.7 is what a pair of similarity 0.8 shares of its sketch with all but 1 in 400."""
    runs, miss = 1, 1 - run_recall()
    while 1 - miss ** runs < recall:
        runs += 1
    return runs


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text.  Fewer words than a shingle make one; no words, none."""
    hashes, _, _, owner = word_hashes(data, offsets)
    grams = rolling(hashes, SHINGLE, SHINGLE)
    bounds = np.searchsorted(owner, np.arange(len(offsets)))
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= SHINGLE:
            out.append(np.unique(grams[a:b - SHINGLE + 1]))
        elif b > a:
            short = np.zeros(1, np.uint64)
            for h in hashes[a:b]:
                short = mix(short * np.uint64(0x9FB21C651E98DF25) + h + np.uint64(1))
            out.append(short)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def sketch(items: np.ndarray) -> np.ndarray:
    """``T`` min-hash values of a set."""
    x = (items >> np.uint64(32)).astype(np.uint32)[:, None]
    least = np.full(T, 0xFFFFFFFF, np.uint32)
    for lo in range(0, len(x), 4096):
        least = np.minimum(least, (x[lo:lo + 4096] * _A + _B).min(axis=0))
    # The least of many values is small; its bits are spread again.
    return (mix(least.astype(np.uint64) + np.uint64(1)) >> np.uint64(32)).astype(np.uint32)


def digest(items: np.ndarray) -> bytes:
    """16 bytes that equal sets share."""
    return np.array([mix(items + np.uint64(17)).sum(), mix(items ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum()], np.uint64).tobytes()


def _described(docs: DataFrame, wanted: np.ndarray | None = None) -> DataFrame:
    """``doc_id, th, tid`` (hash of the text; digest of the shingle set, null without words) with the sketch.

    With a filter of ``tid`` hashes as ``wanted``, only the rows it lets through come, with the text instead.
    """
    shared = None if wanted is None else docs.sparkSession.sparkContext.broadcast(wanted)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column("text")):
                sets = shingle_sets(data, offsets)
                tids = pa.array([digest(s) if len(s) else None for s in sets], pa.binary())
                if shared is None:
                    more = pa.array([sketch(s).tobytes() if len(s) else None for s in sets], pa.binary())
                else:
                    more = batch.column("text").slice(lo, hi - lo)
                out = pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), batch.column("th").slice(lo, hi - lo), tids, more], names=["doc_id", "th", "tid", "more"])
                if shared is not None:
                    # The same hash as Spark's xxhash64 of the digest.
                    names = np.array([xxhash.xxh64_intdigest(digest(s), 42) for s in sets], np.uint64)
                    out = out.filter(pa.array(passes(shared.value, names) & np.array([len(s) > 0 for s in sets], bool)))
                yield out

    kind = "binary" if wanted is None else "string"
    lean = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    named = lean.mapInArrow(describe, f"doc_id long, th long, tid binary, more {kind}")
    return named.withColumnRenamed("more", "sketch" if wanted is None else "text")


def _children(node: np.ndarray, sketches: np.ndarray, branch: int) -> np.ndarray:
    """The children, one per sampled coordinate, that each set goes to from its node."""
    out = np.empty((len(node), branch), np.uint64)
    for j in range(branch):
        at = mix(node * np.uint64(0x9E3779B97F4A7C15) + np.uint64(j + 1)) % np.uint64(T)
        value = sketches[np.arange(len(node)), at.astype(np.int64)].astype(np.uint64)
        out[:, j] = mix(node + mix(at << np.uint64(32) | value))
    return out


def _split(frame: DataFrame, columns: list[str], branch: int) -> DataFrame:
    """``parent, child, tid`` from ``node, tid, sketch``."""

    def split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                node = f["node"].to_numpy(np.int64).view(np.uint64)
                made = _children(node, np.frombuffer(b"".join(f["sketch"]), np.uint32).reshape(-1, T), branch)
                yield pd.DataFrame({
                    "parent": np.repeat(node.view(np.int64), branch), "node": made.reshape(-1).view(np.int64), "tid": np.repeat(f["tid"].to_numpy(), branch),
                })

    return frame.select(*columns).mapInPandas(split, "parent long, node long, tid binary")


def leaves(texts: DataFrame, recall: float = RECALL) -> DataFrame:
    """``leaf, size, tid``: the nodes to compare by brute force, from ``tid, sketch``."""
    roots = F.explode(F.array(*[F.lit(int(mix(np.array([r + 1], np.uint64)).view(np.int64)[0])) for r in range(runs_for(recall))]))
    level = computed_once(_split(texts.select("tid", "sketch", roots.alias("node")), ["node", "tid", "sketch"], BRANCH).select("node", "tid"), "nodes")
    found = []
    for depth in range(1, DEPTH + 1):
        sizes = level.groupBy("node").agg(F.count("*").alias("size")).where("size > 1")
        sized = computed_once(level.join(sizes, "node"), "sized")
        if depth == DEPTH:
            found.append(sized)
            break
        found.append(sized.where(F.col("size") <= SMALL))
        big = sized.where(F.col("size") > SMALL)
        if big.isEmpty():
            break
        split = computed_once(_split(big.join(texts.select("tid", "sketch"), "tid"), ["node", "tid", "sketch"], BRANCH), "split")
        shares = split.groupBy("parent", "node").agg(F.count("*").alias("n")).groupBy("parent").agg(
            F.sum(F.col("n").cast("double") * F.col("n")).alias("pairs"), (F.sum("n") / BRANCH).alias("size"),
        )
        # The part of pairs that agree on the sampled values estimates the mean similarity in the node.
        alike = shares.select(F.col("parent").alias("node"), (F.col("pairs") / (BRANCH * F.col("size") * F.col("size")) >= ALIKE).alias("alike"))
        found.append(big.join(alike.where("alike"), "node").select("node", "tid", "size"))
        level = computed_once(split.join(alike.where("NOT alike").select(F.col("node").alias("parent")), "parent").select("node", "tid"), "nodes")
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out.select(F.col("node").alias("leaf"), "size", "tid").distinct()


def _groups(pdf: pd.DataFrame) -> Iterator[tuple[np.ndarray, int, bool]]:
    """Row numbers, leaf, and whether both blocks are one, of each brute-force group in a bucket of them."""
    leaf, bi, bj = (pdf[c].to_numpy(np.int64) for c in ("leaf", "bi", "bj"))
    order = np.lexsort((bj, bi, leaf))
    new = np.r_[True, (np.diff(leaf[order]) != 0) | (np.diff(bi[order]) != 0) | (np.diff(bj[order]) != 0)]
    cuts = np.r_[np.flatnonzero(new), len(order)]
    for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if hi - lo > 1:
            yield order[lo:hi], int(leaf[order[lo]]), bool(bi[order[lo]] == bj[order[lo]])


def _candidates(pdf: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of each group that look alike by their sketches and whose smallest common leaf this is."""
    sketches = np.frombuffer(b"".join(pdf["small"]), np.uint8).reshape(-1, T)
    block = pdf["block"].to_numpy()
    lists = [frozenset(x) for x in pdf["leaves"].map(lambda x: x.tolist())]
    cut = SKETCH_CUT * T
    for rows, leaf, diagonal in _groups(pdf):
        left, right = [], []
        for k in range(len(rows) - 1):
            i, rest = rows[k], rows[k + 1:]
            if not diagonal:
                rest = rest[block[rest] != block[i]]
            for j in rest[np.count_nonzero(sketches[rest] == sketches[i], axis=1) >= cut].tolist():
                if min(lists[i] & lists[j]) == leaf:
                    left.append(i)
                    right.append(j)
        if left:
            yield np.array(left, np.int64), np.array(right, np.int64)


_PLACE = "leaf long, bi int, bj int, block int, tid binary"


def _flag(pdf: pd.DataFrame) -> pd.DataFrame:
    found = [np.union1d(left, right) for left, right in _candidates(pdf)]
    return pdf.iloc[np.concatenate(found) if found else []][["leaf", "bi", "bj", "block", "tid"]]


def _in_buckets(frame: DataFrame, rows: int, per_bucket: int, function, schema: str) -> DataFrame:
    """Apply a function to buckets of whole groups with about ``per_bucket`` rows: most groups have two or three."""
    bucket = F.pmod(F.xxhash64("leaf", "bi", "bj"), F.lit(max(1, -(-rows // per_bucket))))
    return frame.withColumn("bucket", bucket).groupBy("bucket").applyInPandas(function, schema)


def _sets_of(texts: list[str]) -> list[np.ndarray]:
    data, column = [], pa.array(texts, pa.large_string())
    for _, _, raw, offsets in slices(column):
        data += shingle_sets(raw, offsets)
    return data


def _overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of pairs of sets."""
    if len(left) <= 2 * len(sets):
        return np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(left, right)], np.int64)
    items, column = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = np.bincount(column, minlength=len(items)) > 1
    place = np.cumsum(shared) - 1
    keep = shared[column]
    column, owner = place[column[keep]], owner[keep]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    gram = np.zeros((len(sets), len(sets)), np.float64)
    for lo in range(0, int(shared.sum()), 2048):
        a, b = np.searchsorted(column, [lo, lo + 2048])
        part = np.zeros((len(sets), 2048), np.float32)
        part[owner[a:b], column[a:b] - lo] = 1
        gram += part @ part.T
    return gram[left, right].astype(np.int64)


_LINKED = "tid binary, root binary, n_texts long, n_docs long"


def _verify(pdf: pd.DataFrame, similarity: float) -> pd.DataFrame:
    """Exact similarities of the candidates: for each text its links and the smallest text it is connected to in its group."""
    names, at = np.unique(pdf["tid"].to_numpy(), return_inverse=True)
    first = np.unique(at, return_index=True)[1]
    sets = _sets_of(pdf["text"].iloc[first].tolist())
    sizes = np.array([len(s) for s in sets], np.int64)
    copies = pdf["n"].to_numpy(np.int64)[first]
    parts = []
    for left, right in _candidates(pdf):
        left, right = at[left], at[right]
        mine, back = np.unique(np.concatenate((left, right)), return_inverse=True)
        a, b = back[:len(left)], back[len(left):]
        common = _overlaps([sets[m] for m in mine], a, b)
        near = common >= similarity * (sizes[left] + sizes[right] - common) - 1e-9
        a, b = a[near], b[near]
        n_texts, n_docs, root = np.zeros(len(mine), np.int64), np.zeros(len(mine), np.int64), np.arange(len(mine))
        for x, y in ((a, b), (b, a)):
            np.add.at(n_texts, x, 1)
            np.add.at(n_docs, x, copies[mine[y]])
        while True:
            low = np.minimum(root[a], root[b])
            new = root.copy()
            np.minimum.at(new, a, low)
            np.minimum.at(new, b, low)
            if (new == root).all():
                break
            root = new
        linked = np.flatnonzero(n_texts)
        parts.append(pd.DataFrame({"tid": names[mine[linked]], "root": names[mine[root[linked]]], "n_texts": n_texts[linked], "n_docs": n_docs[linked]}))
    return pd.concat(parts) if parts else pd.DataFrame({"tid": [], "root": [], "n_texts": [], "n_docs": []}).astype({"n_texts": "int64", "n_docs": "int64"})


def join(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """``doc_id, th, tid, class_id, n_links, n_texts, keeps`` per document; ``th`` is ``xxhash64`` of the text.

    Needs ``doc_id, text``; other columns are ignored.  Two documents are linked if the Jaccard similarity of their
    shingle sets is at least ``similarity``; ``n_links`` counts the linked documents, ``n_texts`` the linked texts with
    another set.  ``class_id`` is the smallest ``doc_id`` of those connected by links (null if none has one);
    ``keeps`` marks that document and its copies with the same id, and every document without words.  A text
    of one to four words has one shingle; a null text or one without words has no ``tid``, no links and a class of
    its own.  Documents with equal sets are one text with copies, so they are not compared with each other; repeated
    rows count as copies.  An empty table gives no rows.  The sets are verified whole; the sketches only choose whom
    to compare, and miss a link with a probability of at most ``1 - recall``.
    """
    small_batches(docs.sparkSession)
    described = computed_once(_described(docs), "sketches")
    texts = computed_once(described.where("tid IS NOT NULL").groupBy("tid").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("n"), F.first("sketch").alias("sketch"),
    ), "texts")
    met = computed_once(leaves(texts, recall), "leaves")
    lists = met.groupBy("tid").agg(F.collect_list("leaf").alias("leaves"))
    fold = F.transform(F.sequence(F.lit(1), F.lit(T)), lambda i: F.substring(F.col("sketch"), (4 * i - 3).cast("int"), F.lit(1)))
    known = computed_once(lists.join(texts, "tid").select(
        "tid", "n", "leaves", F.unhex(F.array_join(F.transform(fold, lambda b: F.hex(b)), "")).alias("small"),
    ), "members")
    many = F.ceil(F.col("size") / BLOCK).cast("int")
    blocks = F.when(F.col("size") <= 2 * BLOCK, 1).otherwise(many)
    placed = met.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("tid", "leaf"), F.col("blocks")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)),
    ).select("leaf", F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"), "block", "tid")
    flagged = computed_once(_in_buckets(placed.join(known, "tid"), placed.count(), 2000, _flag, _PLACE), "candidates")
    wanted = computed_once(flagged.select("tid").distinct(), "wanted")
    # The texts to verify are read again behind a filter of fixed size; what it lets through too much goes in the join.
    passed = _described(docs, name_filter(wanted.select(F.xxhash64("tid").alias("name"))))
    content = computed_once(
        passed.select("tid", "text").join(wanted, "tid", "left_semi").groupBy("tid").agg(F.first("text").alias("text")), "candidate-texts")
    linked = computed_once(
        _in_buckets(flagged.join(known, "tid").join(content, "tid"), flagged.count(), 500, lambda g: _verify(g, similarity), _LINKED), "links")
    counts = linked.groupBy("tid").agg(F.sum("n_texts").alias("n_texts"), F.sum("n_docs").alias("n_docs"))
    roots = components(linked.select(F.col("tid").alias("v"), F.col("root").alias("u")))
    named = texts.select("tid", "rep", "n").join(roots.select(F.col("v").alias("tid"), "root"), "tid", "left").withColumn("root", F.coalesce("root", "tid"))
    first = F.struct(F.col("rep").isNull(), F.col("rep"), F.col("tid"))
    classes = named.groupBy("root").agg(F.min("rep").alias("class_id"), F.min_by("tid", first).alias("keeper"))
    found = named.join(classes, "root").join(counts, "tid", "left").select(
        F.col("tid").alias("tid_"), "class_id", (F.col("tid") == F.col("keeper")).alias("kept"), (F.col("n") - 1 + F.coalesce("n_docs", F.lit(0))).alias("n_links"), F.coalesce("n_texts", F.lit(0)).alias("n_texts"),
    )
    return described.select("doc_id", "th", "tid").join(found, F.col("tid") == F.col("tid_"), "left").select(
        "doc_id", "th", "tid", F.when(F.col("tid").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("n_texts", F.lit(0)).cast("long").alias("n_texts"),
        (F.col("tid").isNull() | (F.col("kept") & F.col("doc_id").eqNullSafe(F.col("class_id")))).alias("keeps"),
    )
