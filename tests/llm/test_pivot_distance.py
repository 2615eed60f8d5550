import math
from collections import Counter

import numpy as np
import pytest

from flowbook.llm import pivot_distance

SCHEMA = "vec_id long, embedding array<float>, uid long, size string, v string"


def plain_search(rows, every, top):
    usable = [(i, [min(max(math.floor(1024 * float(x)), -(1 << 28)), 1 << 28) for x in e]) for i, e in rows if e and all(x is not None and math.isfinite(x) for x in e)]
    out = Counter()
    for n, (i, q) in enumerate(usable):
        if i is None or i % every:
            continue
        scores = [(-sum(a * b for a, b in zip(q, x)), j is None, j) for m, (j, x) in enumerate(usable) if m != n and len(x) == len(q)]
        for rank, (score, _, j) in enumerate(sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:top], 1):
            out[i, rank, j, -score] += 1
    return out


def run(spark, rows, every=5, top=4):
    table = spark.createDataFrame([(i, e, 1, "x", "y") for i, e in rows], SCHEMA).repartition(5)
    return Counter(tuple(r) for r in pivot_distance.search(table, every, top).collect())


def f32(x):
    return [float(v) for v in np.asarray(x, np.float32)]


@pytest.fixture
def small(monkeypatch):
    """Many rings, lots and blocks on a small table."""
    for name, value in {"CELL_ROWS": 8, "SAMPLE_ROWS": 60, "LOT_ROWS": 10, "LOT_QUERIES": 7, "ROUNDS": (1, 3, 4096)}.items():
        monkeypatch.setattr(pivot_distance, name, value)


def clustered(n, seed=1, dims=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, dims))
    return [(k, f32(centres[k % 5] + rng.normal(size=dims) * 0.1)) for k in range(n)]


def test_clusters_against_brute_force(spark, small):
    rows = clustered(300)
    assert run(spark, rows) == plain_search(rows, 5, 4)


def test_awkward_vectors(spark, small):
    nan, inf = float("nan"), float("inf")
    rows = clustered(60) + [
        (100, None), (105, []), (110, f32([nan] * 6)), (115, f32([inf, 1, 1, 1, 1, 1])), (120, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (125, f32([0] * 6)), (None, f32([1] * 6)),
        (None, None), (130, f32([1] * 6)), (130, f32([1] * 6)), (130, f32([2] * 6)), (-5, f32([-1] * 6)), (-7, f32([1] * 6)), (140, f32([1e6, -1e6, 3, 4, 5, 6])),
        (200, f32([1, 2])), (205, f32([3, 1])), (206, f32([-3, 1])), (300, f32([0.5] * 9)),
    ]
    assert run(spark, rows) == plain_search(rows, 5, 4)


def test_ties_and_a_hot_vector(spark, small):
    rows = [(k, f32([0.1, 0.2, 0.3])) for k in range(120)] + clustered(60, dims=3)[:40]
    rows = [(k, e) for k, (_, e) in enumerate(rows)]
    assert run(spark, rows, every=10) == plain_search(rows, 10, 4)


def test_few_candidates_and_none(spark):
    rows = [(0, f32([1, 0])), (1, f32([0, 1])), (2, f32([1, 1]))]
    assert run(spark, rows) == plain_search(rows, 5, 4)
    assert run(spark, [(0, f32([1, 0]))]) == Counter()
    assert run(spark, []) == Counter()


def test_bounds_leave_far_rings_out(spark, small):
    rows = clustered(300)
    table = spark.createDataFrame([(i, e, 1, "x", "y") for i, e in rows], SCHEMA)
    queries, _, visits = pivot_distance.searched(table, 5, 4)
    rings = table.count() // 8
    done = sum(r.n for v in visits for r in v.select("n").collect())
    assert done < 0.5 * queries.count() * rings
