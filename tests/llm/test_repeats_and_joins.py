import random

import numpy as np
import pytest

from flowbook.llm import bwt_merge, chosen_path, components, recompression, repeats

from .conftest import words


def brute(rows, unit, window):
    """Removed places by document row: windows that also start in a smaller id."""
    parts = [(i, (t or "").encode()) for i, t, _ in rows]
    parts = [(i, t.split() if unit == "words" else t) for i, t in parts]
    first = {}
    for i, s in parts:
        for p in range(len(s) - window + 1):
            key = tuple(s[p:p + window])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, s in parts:
        gone = np.zeros(len(s) + 1, int)
        for p in range(len(s) - window + 1):
            if i is not None and first[tuple(s[p:p + window])] < i:
                gone[p] += 1
                gone[p + window] -= 1
        out.append((i, s, np.cumsum(gone[:-1]) == 0))
    return out


@pytest.mark.parametrize("window", [5, 50])
def test_word_windows(docs, empty, awkward, window):
    found = sorted((repr(r.doc_id), r.n_words, r.n_removed, r.kept) for r in recompression.remove_repeats(docs, window).collect())
    want = sorted((repr(i), len(s), int((~k).sum()), b" ".join(w for w, x in zip(s, k) if x).decode()) for i, s, k in brute(awkward, "words", window))
    assert found == want
    assert recompression.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("window", [30, 50])
def test_byte_windows(docs, empty, awkward, window):
    found = sorted((repr(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in bwt_merge.remove_repeats(docs, window).collect())
    want = []
    for i, s, k in brute(awkward, "bytes", window):
        runs = int(np.count_nonzero(np.diff(np.r_[1, k.astype(np.int8)]) == -1))
        want.append((repr(i), len(s), int((~k).sum()), runs, bytes(np.frombuffer(s, np.uint8)[k]) if s else b""))
    assert found == sorted(want)
    assert bwt_merge.remove_repeats(empty).count() == 0


def test_lots_of_a_hot_anchor_are_merged_two_by_two(docs, awkward, monkeypatch):
    monkeypatch.setattr(bwt_merge, "LOT_ROWS", 3)
    monkeypatch.setattr(bwt_merge, "SHARD_BYTES", 200)
    found = sorted((repr(r.doc_id), r.n_removed) for r in bwt_merge.remove_repeats(docs).collect())
    assert found == sorted((repr(i), int((~k).sum())) for i, _, k in brute(awkward, "bytes", 50))


def test_merged_transform_orders_suffixes():
    rng = random.Random(1)
    strings = [[rng.randint(1, 3) for _ in range(rng.randint(1, 40))] for _ in range(9)]
    shards = [np.array([c for s in strings[k::3] for c in [*s, 0]], np.uint16) for k in range(3)]
    z, place, block = bwt_merge.merged_blocks(shards, 6)
    names = []
    for s, p in zip(z.tolist(), place.tolist()):
        rest = shards[s][p:].tolist()
        names.append(rest[:rest.index(0)][:6])
    assert names == sorted(names)
    for a, b, x, y in zip(names, names[1:], block, block[1:]):
        assert (x == y) == (a == b and len(a) == 6)


def test_equal_windows_get_equal_marks():
    rng = np.random.default_rng(2)
    for letters in (1, 2, 40):
        a = rng.integers(0, letters, 400).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        names, where, many = recompression.marks_of(np.concatenate((a, a[7:300])), np.repeat([0, 1], [400, 293]), 50)
        of = {}
        for n, p, m in zip(names.tolist(), where.tolist(), many.tolist()):
            of.update({p + k: n for k in range(m)})
        assert set(of) == {*range(351), *range(400, 644)}
        assert all(of[p] == of[p - 7 + 400] for p in range(7, 251))


def test_owner_is_the_least_item_that_holds_the_window():
    rng = np.random.default_rng(4)
    low = rng.integers(0, 60, 40)
    high = np.minimum(low + rng.integers(0, 20, 40), 60)
    rank = rng.integers(0, 15, 40)
    got = repeats.owners(low, high, rank, 60)
    for w in range(60):
        inside = [(rank[k], low[k], k) for k in range(40) if low[k] <= w < high[k]]
        assert got[w] == (min(inside)[2] if inside else -1) or (rank[got[w]], low[got[w]]) == min(inside)[:2]


def shingles(text):
    ws = (text or "").encode().split()
    return frozenset(tuple(ws[i:i + 5]) for i in range(len(ws) - 4)) if len(ws) >= 5 else frozenset([tuple(ws)]) if ws else frozenset()


def links(rows):
    sets = [shingles(t) for _, t, _ in rows]
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and sets[b] and 9 * len(sets[a] & sets[b]) >= 4 * (len(sets[a]) + len(sets[b]))]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    count = [0] * len(rows)
    for a, b in pairs:
        parent[root(a)] = root(b)
        count[a] += 1
        count[b] += 1
    members = {}
    for k in range(len(rows)):
        members.setdefault(root(k), []).append(k)
    named = {}
    for group in members.values():
        ids = [rows[k][0] for k in group if rows[k][0] is not None]
        for k in group:
            named[k] = (min(ids) if ids else None) if sets[k] else rows[k][0]
    return sorted((repr(rows[k][0]), repr(named[k]), count[k]) for k in range(len(rows)))


def near_copies():
    rng = random.Random(8)
    rows = []
    for group in range(6):
        base = words(rng, 150).split()
        for copy in range(30 if group == 0 else 4):
            text = list(base)
            for _ in range(rng.randint(0, 4)):
                text[rng.randrange(150)] = words(rng, 1)
            rows.append((len(rows), " ".join(text), "s"))
    return rows


def test_join_on_awkward_rows(docs, empty, awkward):
    found = chosen_path.join(docs).collect()
    assert sorted((repr(r.doc_id), repr(r.class_id), r.n_links) for r in found) == links(awkward)
    assert chosen_path.join(empty).count() == 0
    kept = [r for r in found if r.tid is not None and r.keeps]
    assert {bytes(r.tid) for r in kept} and all(r.doc_id == r.class_id for r in kept)


@pytest.mark.parametrize("small, block", [(64, 256), (4, 5)])
def test_join_finds_all_links_of_near_copies(spark, monkeypatch, small, block):
    monkeypatch.setattr(chosen_path, "SMALL", small)
    monkeypatch.setattr(chosen_path, "BLOCK", block)
    rows = near_copies()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = sorted((repr(r.doc_id), repr(r.class_id), r.n_links) for r in chosen_path.join(df).collect())
    assert found == links(rows)


def test_runs_reach_the_recall():
    assert 1 - (1 - chosen_path.run_recall()) ** chosen_path.runs_for(0.9999) >= 0.9999


def test_components_of_a_long_path(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    found = components.components(spark.createDataFrame(edges, "v long, u long")).collect()
    assert sorted((r.v, r.root) for r in found) == [*[(k, 0) for k in range(41)], (100, 100), (101, 100)]


def test_name_filters_pass_every_shared_name_and_few_others(spark):
    rng = np.random.default_rng(5)
    names = np.unique(rng.integers(0, 1 << 64, 1_100_000, np.uint64))
    shared, others = names[::2], names[1::2]
    blocks = [r for texts in (names, shared) for b in repeats.packed_names(iter([texts.view(np.int64)])) for r in zip(b.column("part").to_pylist(), b.column("names").to_pylist())]
    bits = repeats.shared_filter(spark.createDataFrame(blocks, "part int, names binary"))
    assert repeats.passes(bits, shared).all() and repeats.passes(bits, others).mean() < 0.005
    hashed = spark.range(800_000).selectExpr("xxhash64(id) AS name")
    own = hashed.toArrow().column("name").to_numpy().view(np.uint64)
    bits = repeats.name_filter(hashed.limit(0).union(hashed.where("name % 2 = 0")))
    even = own.view(np.int64) % 2 == 0
    assert repeats.passes(bits, own[even]).all() and repeats.passes(bits, own[~even]).mean() < 0.005
