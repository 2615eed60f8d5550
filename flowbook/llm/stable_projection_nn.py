"""Nearest neighbours by low-dimensional stable projections, indexed by a kd-tree and ended by a chi-square test.

Largest inner product is nearest distance once every vector is lifted to one length (one more component) and the
query is scaled to that length.  Gaussian projections to ``M`` dimensions keep distances up to a factor whose square
is chi-square with ``M`` degrees of freedom.  Cells of a kd-tree over the projected space whose boxes are near enough are
opened, their vectors are verified one after the other in the order of their projected distance, in double precision,
and the search ends when a vector as near as the current last neighbour would, with probability ``CONFIDENCE``, have
had a nearer projection than any left.  A true neighbour is missed with a chance of ``1 - CONFIDENCE`` at most.

The top of the tree divides the table into cells that Spark groups by; each group builds the lower levels itself.
Round one searches a query's own cell, which bounds round two to the cells the test does not rule out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import computed_once

M = 32
CONFIDENCE = 0.999
K = 20
SEED = 20
SAMPLE_ROWS, LEAST_SAMPLE = 20_000, 1024
CELL_ROWS = 4096
MOST_CELLS = 1024
GROUP_ROWS, GROUP_QUERIES = 8192, 2048
BUCKET = 64
BLOCK, CHUNK = 64, 128


def chi_square_cdf(x: np.ndarray, m: int = M) -> np.ndarray:
    """For an even number of degrees of freedom."""
    half = np.asarray(x, float) / 2
    return 1 - np.exp(-half) * sum(half ** i / math.factorial(i) for i in range(m // 2))


def chi_square_quantile(p: float, m: int = M) -> float:
    lo, hi = 0.0, 1e3
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi_square_cdf(mid, m) < p else (lo, mid)
    return hi


STOP = chi_square_quantile(CONFIDENCE)


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, embedding`` (doubles) of the rows that take part, each different one once.

    Out stay rows with a null id, and vectors null, empty, zero, or with a null or non-finite component.
    """
    v = F.col("embedding")
    fine = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.cast("array<double>").alias("embedding")).where(
        F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0)
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0),
    )
    return fine.dropDuplicates(["vec_id", "embedding"])


def few_of_each(fine: DataFrame, k: int) -> DataFrame:
    """The rows with the ``k + 1`` smallest ids of each vector.  Each input partition is cut before the shuffle, so a hot vector fills no task."""
    few = Window.partitionBy("_v").orderBy("vec_id")
    return fine.withColumn("_v", F.xxhash64("embedding")).withColumn("_row", F.row_number().over(few)).where(F.col("_row") <= k + 1).select("vec_id", "_v", "embedding")


def _stack(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), float)


def _by_length(frame: pd.DataFrame) -> Iterator[tuple[int, pd.DataFrame]]:
    """The rows of each vector length."""
    yield from frame.groupby(frame["embedding"].map(len), sort=False)


def _top_of_tree(points: np.ndarray, cells: int) -> list[tuple[int, float]]:
    """Splits of a complete tree in heap order: dimension and value, cut at the median of the widest dimension."""
    splits: list[tuple[int, float]] = []
    level = [points]
    while len(level) < cells:
        below = []
        for part in level:
            if len(part):
                dim = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
                value = float(np.median(part[:, dim]))
            else:
                dim, value = 0, 0.0
            splits.append((dim, value))
            right = part[:, dim] > value
            below += [part[~right], part[right]]
        level = below
    return splits


def _cell_of(points: np.ndarray, splits: list[tuple[int, float]]) -> np.ndarray:
    at = np.zeros(len(points), np.int64)
    if not splits:
        return at
    dims, values = np.array([s[0] for s in splits]), np.array([s[1] for s in splits])
    for _ in range((len(splits) + 1).bit_length() - 1):
        at = 2 * at + 1 + (points[np.arange(len(points)), dims[at]] > values[at])
    return at - len(splits)


def _regions(splits: list[tuple[int, float]]) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper edges of every cell."""
    level = [(np.full(M, -np.inf), np.full(M, np.inf))]
    at = 0
    while at < len(splits):
        below = []
        for lo, hi in level:
            dim, value = splits[at]
            at += 1
            left, right = hi.copy(), lo.copy()
            left[dim], right[dim] = min(hi[dim], value), max(lo[dim], value)
            below += [(lo, left), (right, hi)]
        level = below
    return np.array([r[0] for r in level]), np.array([r[1] for r in level])


def _gaps(point: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Squared distance from a point to each box."""
    off = np.maximum(np.maximum(lo - point, point - hi), 0)
    return (off * off).sum(axis=1)


def _buckets(points: np.ndarray) -> list[np.ndarray]:
    """The lower levels of the tree: row numbers of each leaf, at most ``BUCKET`` unless all points coincide."""
    out, todo = [], [np.arange(len(points))]
    while todo:
        rows = todo.pop()
        spread = np.ptp(points[rows], axis=0)
        dim = int(spread.argmax())
        if len(rows) <= BUCKET or spread[dim] == 0:
            out.append(rows)
            continue
        order = rows[np.argsort(points[rows, dim], kind="stable")]
        todo += [order[:len(order) // 2], order[len(order) // 2:]]
    return out


def _search(pdf: pd.DataFrame, k: int, lengths: dict[int, float]) -> pd.DataFrame:
    """The ``k`` nearest of a group's vectors for each of its queries; ``verified`` says how many were looked at."""
    data, queries = pdf[~pdf["is_query"]], pdf[pdf["is_query"]]
    found: dict[str, list] = {"query_id": [], "query_v": [], "vec_id": [], "score": [], "verified": []}
    if len(data) and len(queries):
        ids, vectors, points = data["vec_id"].to_numpy(np.int64), _stack(data["embedding"]), _stack(data["projected"])
        length, leaves = lengths[vectors.shape[1]], _buckets(points)
        lo, hi = np.array([points[r].min(axis=0) for r in leaves]), np.array([points[r].max(axis=0) for r in leaves])
        leaf_of = np.empty(len(points), np.int64)
        for n, rows in enumerate(leaves):
            leaf_of[rows] = n
        squares = (points * points).sum(axis=1)
        for at in range(0, len(queries), CHUNK):
            part = queries.iloc[at:at + CHUNK]
            projected = _stack(part["projected"])
            apart = np.maximum((projected * projected).sum(axis=1)[:, None] + squares - 2 * projected @ points.T, 0)
            for own, own_v, vector, point, bound, far in zip(
                part["vec_id"].tolist(), part["_v"].tolist(), _stack(part["embedding"]), projected, part["bound"].tolist(), apart,
            ):
                best_ids, best, verified = _nearest(own, vector, bound, far, _gaps(point, lo, hi)[leaf_of], ids, vectors, k, length)
                found["query_id"] += [own] * len(best)
                found["query_v"] += [own_v] * len(best)
                found["vec_id"] += best_ids.tolist()
                found["score"] += best.tolist()
                found["verified"] += [verified] * len(best)
    return pd.DataFrame(found).astype({"query_id": "int64", "query_v": "int64", "vec_id": "int64", "score": "float64", "verified": "int64"})


def _nearest(
    own: int, vector: np.ndarray, bound: float, far: np.ndarray, gaps: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int, length: float,
) -> tuple[np.ndarray, np.ndarray, int]:
    """Ids and scores of the best of a group's vectors, by increasing projected distance ``far``; ``gaps`` are those of their boxes."""
    scale = length / math.sqrt(float((vector * vector).sum()))

    def limit(last: float) -> float:
        # Squared distance to the last neighbour after lifting; rounding may push it below 0.
        return STOP * max(2 * length * length - 2 * scale * last, 0.0) + 1e-9 * length * length if last > -np.inf else np.inf

    rows = np.flatnonzero((gaps <= limit(bound)) & (far <= limit(bound)) & (ids != own))
    rows = rows[np.argsort(far[rows], kind="stable")]
    best_ids, best, at, size = np.zeros(0, np.int64), np.zeros(0), 0, max(BLOCK, k)
    while at < len(rows):
        last = max(bound, best[-1] if len(best) >= k else -np.inf)
        if far[rows[at]] > limit(last):
            break
        # Of the next block, too, only what the test still leaves open.
        block = rows[at:at + size][far[rows[at:at + size]] <= limit(last)]
        best_ids, best = np.concatenate((best_ids, ids[block])), np.concatenate((best, (vectors[block] * vector).sum(axis=1)))
        order = np.lexsort((best_ids, -best))[:k]
        best_ids, best = best_ids[order], best[order]
        at += len(block)
        size *= 2
    return best_ids, best, at


def search(vectors: DataFrame, every: int = 20, k: int = K) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows of each row whose id is divisible by ``every``.

    Needs ``vec_id, embedding``; other columns are ignored.  ``usable`` says which rows take part.  Nearness is the
    largest inner product, among vectors of the query's own number of components; ties go to the smaller id; a query's
    own id is left out; with fewer than ``k`` others all of them come.  Rows of one id with different vectors are rows
    of their own: each is answered with its own ranks, and each can be in a result.  An empty table gives no rows.

    Equal vectors have equal scores with any query, so only the ``k + 1`` smallest ids of each vector can be in a
    result; that keeps a vector with a large share of the rows from filling a cell.  Groups hold at most about
    ``GROUP_ROWS`` vectors and ``GROUP_QUERIES`` queries: larger cells are split by hash, and their queries go to
    every part.  Each number of components has a tree of its own.  The trees' tops come from about ``SAMPLE_ROWS`` rows
    with the smallest id hashes, and have at most ``MOST_CELLS`` cells each.
    """
    spark = vectors.sparkSession
    out = "query_id long, rank int, vec_id long, score double"
    fine = computed_once(usable(vectors), "vectors")
    squares = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x)
    shape = {r["d"]: r for r in fine.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n"), F.max(squares).alias("most")).orderBy("d").collect()}
    if not shape:
        return spark.createDataFrame([], out)
    lengths = {d: math.sqrt(r["most"]) for d, r in shape.items()}
    axes = {d: np.random.default_rng(SEED).standard_normal((d + 1, M)) for d in shape}

    def lifted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for d, part in _by_length(frame):
                v = _stack(part["embedding"])
                rest = np.sqrt(np.maximum(lengths[d] * lengths[d] - (v * v).sum(axis=1), 0))
                yield part.assign(projected=list(v @ axes[d][:-1] + rest[:, None] * axes[d][-1]))

    def scaled(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for d, part in _by_length(frame):
                v = _stack(part["embedding"])
                scale = lengths[d] / np.sqrt((v * v).sum(axis=1))
                yield part.assign(projected=list((v * scale[:, None]) @ axes[d][:-1]))

    made = "vec_id long, _v long, embedding array<double>, projected array<double>"
    kept = computed_once(few_of_each(fine, k).mapInPandas(lifted, made), "projected")
    queries = fine.where(F.col("vec_id") % every == 0).select("vec_id", F.xxhash64("embedding").alias("_v"), "embedding").mapInPandas(scaled, made)
    rows = sum(r["n"] for r in shape.values())
    taken = {d: max(LEAST_SAMPLE, SAMPLE_ROWS * r["n"] // rows) for d, r in shape.items()}
    cells = {d: 1 << min(MOST_CELLS.bit_length() - 1, (taken[d] // 8).bit_length() - 1, max(0, math.ceil(math.log2(r["n"] / CELL_ROWS)))) for d, r in shape.items()}
    cut = [d for d in shape if cells[d] > 1]
    points: dict[int, np.ndarray] = {d: np.zeros((0, M)) for d in shape}
    if cut:
        share = F.element_at(F.create_map(*[F.lit(x) for d in cut for x in (d, taken[d])]), F.col("d"))
        first_ids = Window.partitionBy("d").orderBy(F.xxhash64("vec_id"), "vec_id", "_v")
        few = kept.select("vec_id", "_v", "projected", F.size("embedding").alias("d")).where(F.col("d").isin(cut)).withColumn(
            "_at", F.row_number().over(first_ids)).where((F.col("_at") <= max(taken.values())) & (F.col("_at") <= share))
        points |= {d: _stack(part["projected"]) for d, part in few.select("d", "projected").toPandas().groupby("d")}
    splits = {d: _top_of_tree(points[d], cells[d]) for d in shape}
    low, high = ({d: edges[i] for d, edges in ((d, _regions(x)) for d, x in splits.items())} for i in (0, 1))
    base = dict(zip(shape, np.cumsum([0, *cells.values()]).tolist()))

    def locate(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for d, part in _by_length(frame):
                yield part.assign(cell=base[d] + _cell_of(_stack(part["projected"]), splits[d]))

    data = kept.mapInPandas(locate, made + ", cell long")
    asked = computed_once(queries.mapInPandas(locate, made + ", cell long"), "queries")
    held = {r["cell"]: r["count"] for r in data.groupBy("cell").count().collect()}
    parts = {c: -(-n // GROUP_ROWS) for c, n in held.items()}

    def by_cell(numbers: dict[int, int]):
        return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in numbers.items() for x in kv]), F.col("cell")), F.lit(0)) if numbers else F.lit(0)

    def round_of(queries: DataFrame) -> DataFrame:
        """Search each query's ``cell``; ``bound`` is a score it has already reached."""
        queries = computed_once(queries, "asked")
        many = {r["cell"]: -(-r["count"] // GROUP_QUERIES) for r in queries.groupBy("cell").count().collect()}
        salted = data.withColumn("part", F.pmod(F.xxhash64("vec_id"), by_cell(parts))).withColumn(
            "lot", F.explode(F.sequence(F.lit(0), F.greatest(by_cell(many), F.lit(1)) - 1)),
        ).select("cell", "part", "lot", "vec_id", "_v", "embedding", "projected", F.lit(False).alias("is_query"), F.lit(None).cast("double").alias("bound"))
        spread = queries.withColumn("lot", F.pmod(F.xxhash64("vec_id"), by_cell(many))).where(by_cell(parts) > 0).withColumn(
            "part", F.explode(F.sequence(F.lit(0), by_cell(parts) - 1)),
        ).select("cell", F.col("part").cast("long"), F.col("lot").cast("int"), "vec_id", "_v", "embedding", "projected", F.lit(True).alias("is_query"), "bound")
        both = salted.unionByName(spread)
        found = both.groupBy("cell", "part", "lot").applyInPandas(lambda pdf: _search(pdf, k, lengths), "query_id long, query_v long, vec_id long, score double, verified long")
        return computed_once(found, "found")

    def nearest(found: DataFrame) -> DataFrame:
        best = Window.partitionBy("query_id", "query_v").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    first = round_of(asked.withColumn("bound", F.lit(float("-inf"))))
    reached = nearest(first).groupBy("query_id", "query_v").agg(F.max(F.when(F.col("rank") == k, F.col("score"))).alias("reached"))
    bounded = asked.join(reached, (F.col("vec_id") == F.col("query_id")) & (F.col("_v") == F.col("query_v")), "left").select(
        "vec_id", "_v", "embedding", "projected", "cell", F.coalesce("reached", F.lit(float("-inf"))).alias("bound"),
    )

    def others(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for d, part in _by_length(frame):
                v, p, length = _stack(part["embedding"]), _stack(part["projected"]), lengths[d]
                scale = length / np.sqrt((v * v).sum(axis=1))
                far = np.maximum(2 * length * length - 2 * scale * part["bound"].to_numpy(float), 0) * STOP + 1e-9 * length * length
                near = [[base[d] + c for c in np.flatnonzero(_gaps(x, low[d], high[d]) <= f).tolist() if base[d] + c != own] for x, f, own in zip(p, far, part["cell"].tolist())]
                yield part.assign(cell=near).explode("cell").dropna(subset=["cell"]).astype({"cell": "int64"})

    second = round_of(bounded.mapInPandas(others, "vec_id long, _v long, embedding array<double>, projected array<double>, cell long, bound double"))
    return nearest(first.unionByName(second)).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
