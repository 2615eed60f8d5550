"""Exact top-k search by a pivot-distance index.

Components become integers and the score is their inner product.  With one more component, that gives all vectors one
length ``M``, the largest scores are the smallest distances: ``|q - x|^2 = |q|^2 + M^2 - 2 q.x``.  Every vector is
keyed by its nearest pivot and its distance from it; a *cell* is a ring of such distances (an annulus).  By the
triangle inequality a ring at distances ``low .. high`` from pivot ``p`` holds nothing nearer to ``q`` than
``max(low - d(q, p), d(q, p) - high)``.  Each query visits cells in the order of these bounds and is finished when the
next bound is above its k-th distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..session import computed_once

SCALE, EVERY, TOP = 1024, 100, 10
LARGEST = 1 << 28
SAMPLE_ROWS = 4096
CELL_ROWS, MOST_CELLS = 2048, 4096
LOT_ROWS, LOT_QUERIES = 8192, 8192
# Cells that a query has visited after each round; the last round takes all that its bound leaves.
ROUNDS = (1, 8, MOST_CELLS)
CHUNK = 256
LOOPS = 4


class Pivots(NamedTuple):
    """Pivots of the vectors of one length, and the inner edges of the rings around each."""

    centres: np.ndarray
    edges: np.ndarray


def _stacked(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<i4").reshape(len(column), -1).astype(np.float64)


def _lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with the component that gives them all the length ``longest``."""
    return np.column_stack((x, np.sqrt(np.maximum(longest * longest - np.einsum("ij,ij->i", x, x), 0))))


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Euclidean distances, computed from differences so that small ones are right too."""
    out = np.empty((len(x), len(centres)))
    for k, c in enumerate(centres):
        out[:, k] = np.sqrt(((x - c) ** 2).sum(axis=1))
    return out


def fit(sample: np.ndarray, cells: int) -> Pivots:
    """Pivots by a few rounds of k-means, and rings of equal shares of the sample; any pivots give right answers."""
    count = max(1, min(int(np.ceil(np.sqrt(cells))), len(sample)))
    rings = -(-cells // count)
    centres = sample[np.linspace(0, len(sample) - 1, count).astype(np.int64)]
    for _ in range(LOOPS):
        near = _distances(sample, centres).argmin(axis=1)
        centres = np.stack([sample[near == k].mean(axis=0) if (near == k).any() else centres[k] for k in range(count)])
    far = _distances(sample, centres)
    near = far.argmin(axis=1)
    quantiles = np.arange(1, rings) / rings
    edges = np.stack([np.quantile(far[near == k, k], quantiles) if (near == k).any() else np.zeros(rings - 1) for k in range(count)])
    return Pivots(centres, edges)


def integers(vectors: DataFrame) -> DataFrame:
    """``uid, vid, unknown, size, v``: usable vectors as floors of ``SCALE`` times their components, as 32-bit bytes."""

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            kept = [x is not None and len(x) > 0 and bool(np.isfinite(x).all()) for x in (None if e is None else np.asarray(e, np.float64) for e in rows["e"])]
            rows = rows.loc[np.array(kept, bool)]
            v = [np.clip(np.floor(np.asarray(e, np.float64) * SCALE), -LARGEST, LARGEST).astype("<i4") for e in rows["e"]]
            yield pd.DataFrame({
                "uid": rows["uid"], "vid": rows["vid"], "unknown": rows["unknown"], "size": np.array([len(x) for x in v], np.int32), "v": [x.tobytes() for x in v],
                "norm2": np.array([float(np.dot(x.astype(np.float64), x)) for x in v], np.float64),
            })

    known = vectors.select(
        F.monotonically_increasing_id().alias("uid"), F.coalesce(F.col("vec_id").cast("long"), F.lit((1 << 63) - 1)).alias("vid"), F.col("vec_id").isNull().alias("unknown"),
        F.expr("CASE WHEN embedding IS NOT NULL AND NOT exists(embedding, x -> x IS NULL) THEN CAST(embedding AS array<double>) END").alias("e"),
    ).where("e IS NOT NULL")
    return computed_once(known.mapInPandas(whole, "uid long, vid long, unknown boolean, size int, v binary, norm2 double"), "vectors")


def index(vectors: DataFrame) -> tuple[DataFrame, dict[int, Pivots], float]:
    """The vectors with ``cell`` and ``d``, stored in that order; the pivots per vector length; the length ``M``.

    Cells are numbered within a vector length.  A length that the sample lacks has one pivot, the origin, and one cell.
    """
    spark = vectors.sparkSession
    facts = vectors.agg(F.count("*"), F.max("norm2")).first()
    longest = float(np.sqrt(facts[1] or 0.0))
    cells = max(1, min(MOST_CELLS, -(-facts[0] // CELL_ROWS)))
    sample = vectors.orderBy(F.xxhash64("uid")).limit(SAMPLE_ROWS).select("size", "v").toPandas()
    fitted = {int(n): fit(_lifted(_stacked(part["v"]), longest), max(1, round(cells * len(part) / len(sample)))) for n, part in sample.groupby("size")}
    shared = spark.sparkContext.broadcast(fitted)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for size, part in rows.groupby("size"):
                pivots = shared.value.get(int(size)) or origin(int(size))
                far = _distances(_lifted(_stacked(part["v"]), longest), pivots.centres)
                near = far.argmin(axis=1)
                d = far[np.arange(len(part)), near]
                ring = np.array([np.searchsorted(pivots.edges[p], x) for p, x in zip(near, d)], np.int64)
                yield part.drop(columns="norm2").assign(cell=(near * (pivots.edges.shape[1] + 1) + ring).astype(np.int32), d=d)

    placed = vectors.mapInPandas(place, "uid long, vid long, unknown boolean, size int, v binary, cell int, d double")
    return computed_once(placed.repartitionByRange("size", "cell", "d", "uid").sortWithinPartitions("size", "cell", "d", "uid"), "pivot-index"), fitted, longest


def origin(size: int) -> Pivots:
    return Pivots(np.zeros((1, size + 1)), np.zeros((1, 0)))


_PACKED = {"uid": np.int64, "floor": np.int64, "far": np.float64, "radius": np.float64}


def _unpacked(blocks: pd.DataFrame) -> pd.DataFrame:
    """One row per query from blocks of queries."""
    columns = {name: np.frombuffer(b"".join(blocks[name]), dtype) for name, dtype in _PACKED.items()}
    v = [block[k * (len(block) // n):(k + 1) * (len(block) // n)] for block, n in zip(map(bytes, blocks["v"]), blocks["n"].tolist()) for k in range(n)]
    return pd.DataFrame({**columns, "v": v})


def _slack(longest: float) -> float:
    """More than rounding can move a distance."""
    return 1e-7 * (longest + 1)


def visit(stored: pd.DataFrame, asked: pd.DataFrame, top: int, longest: float) -> pd.DataFrame:
    """The ``top`` best rows of a lot for each query that visits it, none below the query's floor.

    Rows lie in order of their distance from the pivot; of them, a query meets those between its own distance less and
    plus its radius.
    """
    out = []
    if len(stored) and len(asked):
        stored = stored.sort_values(["d", "uid"])
        x, d, uid, vid = _stacked(stored["v"]), stored["d"].to_numpy(), stored["uid"].to_numpy(), stored["vid"].to_numpy()
        unknown = stored["unknown"].to_numpy()
        asked = _unpacked(asked).sort_values("far")
        exact = x.shape[1] * max(np.abs(x).max(), 1.0) * max(np.abs(_stacked(asked["v"])).max(), 1.0) < 1 << 53
        x = x if exact else x.astype(np.int64)
        by_uid = np.argsort(uid)
        for at in range(0, len(asked), CHUNK):
            part = asked.iloc[at:at + CHUNK]
            q, floor, far, radius = _stacked(part["v"]), part["floor"].to_numpy(), part["far"].to_numpy(), part["radius"].to_numpy()
            low = int(np.searchsorted(d, (far - radius).min() - _slack(longest)))
            high = int(np.searchsorted(d, (far + radius).max() + _slack(longest), "right"))
            if low >= high:
                continue
            scores = (q if exact else q.astype(np.int64)) @ x[low:high].T
            scores = scores.astype(np.int64)
            own = part["uid"].to_numpy()
            place = by_uid[np.minimum(np.searchsorted(uid, own, sorter=by_uid), len(uid) - 1)]
            mine = (uid[place] == own) & (place >= low) & (place < high)
            scores[np.flatnonzero(mine), place[mine] - low] = np.iinfo(np.int64).min
            if high - low > top:
                floor = np.maximum(floor, np.partition(scores, high - low - top, axis=1)[:, high - low - top])
            row, column = np.nonzero((scores >= floor[:, None]) & (scores > np.iinfo(np.int64).min))
            found, of = scores[row, column], column + low
            order = np.lexsort((uid[of], unknown[of], vid[of], -found, row))
            row, of, found = row[order], of[order], found[order]
            begin = np.searchsorted(row, np.arange(len(part)))
            best = np.arange(len(row)) - begin[row] < top
            out.append(pd.DataFrame({"uid": own[row[best]], "cuid": uid[of[best]], "cid": vid[of[best]], "cunknown": unknown[of[best]], "score": found[best]}))
    if out:
        return pd.concat(out)
    return pd.DataFrame({"uid": [], "cuid": [], "cid": [], "cunknown": [], "score": []}).astype({"uid": "int64", "cuid": "int64", "cid": "int64", "cunknown": "bool", "score": "int64"})


def search(vectors: DataFrame, every: int = EVERY, top: int = TOP) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``top`` best candidates of each row whose ``vec_id`` is divisible by ``every``.

    Needs ``vec_id`` and ``embedding``; other columns are ignored.  Candidates are all rows but the query's own, of the
    query's number of components.  Vectors that are null or empty or hold a null or non-finite component take no part;
    components beyond ``LARGEST`` in size count as ``LARGEST``.  Ties go to the smaller ``vec_id``, a null one last;
    a row with a null ``vec_id`` is a candidate and no query.  Repeated rows and rows with one ``vec_id`` are candidates
    and queries each.  With fewer than ``top`` candidates all are returned; an empty table gives no rows.

    Pivots come from ``SAMPLE_ROWS`` rows by hash; every row is indexed and answers are exact with any pivots.  At most
    ``MOST_CELLS`` rings are known to all tasks; beyond ``LOT_ROWS`` rows a ring is dealt by hash into lots, and beyond
    ``LOT_QUERIES`` queries at one ring these are dealt likewise, so no task holds more than one lot of either.
    """
    return answers(*searched(vectors, every, top)[:2], top)


def searched(vectors: DataFrame, every: int = EVERY, top: int = TOP) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """The queries, the best rows found for each, and the visits of every round (for measurements)."""
    spark = vectors.sparkSession
    known = integers(vectors)
    stored, fitted, longest = index(known)
    # At most MOST_CELLS rings and one per vector length beyond the sample's: rows of numbers, bounded by these.
    rings = stored.groupBy("size", "cell").agg(F.count("*").alias("n"), F.min("d").alias("low"), F.max("d").alias("high"))
    rings = computed_once(rings.withColumn("lots", F.ceil(F.col("n") / LOT_ROWS).cast("int")), "rings")
    shared = spark.sparkContext.broadcast((fitted, {int(n): part.sort_values("cell") for n, part in rings.toPandas().groupby("size")}))
    wanted = known.where((F.pmod("vid", F.lit(every)) == 0) & ~F.col("unknown")).select("uid", "vid", "size", "v", "norm2")
    # Few files of many queries, so that rings are visited in large blocks.
    queries = computed_once(wanted.repartition(max(1, -(-wanted.count() // LOT_QUERIES))), "queries")
    lots = rings.select("size", "cell", "lots")
    found, visits, seen = None, [], 0
    for limit in ROUNDS:
        asked = queries.withColumn("floor", F.lit(None).cast("long")) if found is None else queries.join(_floors(found, top), "uid", "left")
        first, last, final = seen, limit, limit == ROUNDS[-1]

        def choose(batches: Iterator[pd.DataFrame], first=first, last=last, final=final) -> Iterator[pd.DataFrame]:
            for rows in batches:
                for size, part in rows.groupby("size"):
                    pivots, about = shared.value[0].get(int(size)) or origin(int(size)), shared.value[1][int(size)]
                    for at in range(0, len(part), CHUNK):
                        yield _chosen(part.iloc[at:at + CHUNK], pivots, about, longest, first, None if final else last)

        told = asked.select("uid", "size", "v", "norm2", F.coalesce("floor", F.lit(0)).alias("floor"), F.col("floor").isNotNull().alias("has"))
        round_ = computed_once(told.mapInPandas(choose, "size int, cell int, n int, uid binary, v binary, floor binary, far binary, radius binary"), "visits")
        visits.append(round_)
        met = _meet(stored, round_, lots, top, longest)
        found = computed_once(met if found is None else _best(found.unionByName(met), top), "found")
        seen = limit
    return queries, found, visits


def _chosen(part: pd.DataFrame, pivots: Pivots, rings: pd.DataFrame, longest: float, first: int, last: int | None) -> pd.DataFrame:
    """For each ring the block of queries that visit it now: it is among their next ones and its bound leaves it open."""
    far = _distances(np.column_stack((_stacked(part["v"]), np.zeros(len(part)))), pivots.centres)[:, rings["cell"].to_numpy() // (pivots.edges.shape[1] + 1)]
    bound = np.maximum(np.maximum(rings["low"].to_numpy() - far, far - rings["high"].to_numpy()), 0)
    have = part["has"].to_numpy()
    floor = np.where(have, part["floor"].to_numpy(), np.iinfo(np.int64).min)
    radius = np.where(have, np.sqrt(np.maximum(part["norm2"].to_numpy() + longest * longest - 2.0 * floor, 0)), np.inf)
    place = np.argsort(np.argsort(bound, axis=1, kind="stable"), axis=1)
    due = (place >= first) & (bound <= radius[:, None] + _slack(longest))
    if last is not None:
        due &= place < last
    uid, v, out = part["uid"].to_numpy(), part["v"].to_numpy(), []
    for k in np.flatnonzero(due.any(axis=0)):
        some = np.flatnonzero(due[:, k])
        packed = {"uid": uid[some], "floor": floor[some], "far": far[some, k], "radius": radius[some]}
        out.append((part["size"].iloc[0], rings["cell"].iloc[k], len(some), b"".join(v[some]), *[packed[c].astype(t).tobytes() for c, t in _PACKED.items()]))
    return pd.DataFrame(out, columns=["size", "cell", "n", "v", *_PACKED])


def _meet(stored: DataFrame, visits: DataFrame, lots: DataFrame, top: int, longest: float) -> DataFrame:
    """Cells and the queries that visit them, lot by lot."""
    blocks = visits.groupBy("size", "cell").agg(F.ceil(F.sum("n") / LOT_QUERIES).cast("int").alias("blocks"))
    dealing = computed_once(lots.join(blocks, ["size", "cell"]), "dealing")
    # A row per ring, so bounded like the rings.
    key = ["size", "cell", "lot", "block"]
    rows = stored.join(F.broadcast(dealing), ["size", "cell"]).select(
        "size", "cell", F.pmod(F.xxhash64("uid"), F.col("lots")).cast("int").alias("lot"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        "uid", "vid", "unknown", "v", "d",
    )
    asked = visits.join(F.broadcast(dealing), ["size", "cell"]).select(
        "size", "cell", F.explode(F.sequence(F.lit(0), F.col("lots") - 1)).alias("lot"), F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int").alias("block"),
        "n", "uid", "v", "floor", "far", "radius",
    )
    return rows.groupBy(*key).cogroup(asked.groupBy(*key)).applyInPandas(
        lambda a, b: visit(a, b, top, longest), "uid long, cuid long, cid long, cunknown boolean, score long",
    )


def _order() -> WindowSpec:
    return Window.partitionBy("uid").orderBy(F.desc("score"), "cid", "cunknown", "cuid")


def _best(found: DataFrame, top: int) -> DataFrame:
    """At most ``top`` rows of each query, the best ones."""
    return found.withColumn("place", F.row_number().over(_order())).where(F.col("place") <= top).drop("place")


def _floors(found: DataFrame, top: int) -> DataFrame:
    """The score a row needs to come among a query's ``top``; none yet for a query with fewer rows."""
    return _best(found, top).groupBy("uid").agg(F.count("*").alias("n"), F.min("score").alias("floor")).where(F.col("n") >= top).select("uid", "floor")


def answers(queries: DataFrame, found: DataFrame, top: int) -> DataFrame:
    ranked = found.withColumn("rank", F.row_number().over(_order())).where(F.col("rank") <= top)
    return ranked.join(queries.select("uid", F.col("vid").alias("query_id")), "uid").select(
        "query_id", F.col("rank").cast("int").alias("rank"), F.when(~F.col("cunknown"), F.col("cid")).alias("vec_id"), "score",
    )
