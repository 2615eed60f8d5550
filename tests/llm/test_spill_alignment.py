import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from flowbook.llm import alignment, spill_counts

ODD = [
    "", "  a  b\n  c  d \x1c e　 f", "x▁y z", "a ", " ", "\n", "<|endoftext|> <s> it's\r\n\t x", "  b \x00 c", "日本語 日本 語" * 5, "x y▁ z", "é ü  ß  q",
    "one \n two  \n\n three", "tail   ", "á   b",
]


@pytest.fixture(scope="module")
def libraries():
    return alignment.Aligner(*alignment.default_paths())


def plain_alignment(found, text):
    """Ids, group text and the list of links of one text, by comparing every end."""
    whole = (" " + text).encode()
    ids_a = found.library_a.encode(" " + text, add_special_tokens=False).ids
    ids_b = found.library_b.encode(text)
    spelled = []
    for side, ids in ((found.a, ids_a), (found.b, ids_b)):
        spelled.append([side.data[side.starts[i]:side.starts[i] + side.sizes[i]].tobytes() for i in ids])
    if not text or any(b"".join(s) != whole for s in spelled):
        return [], [], "", []
    ends = [np.cumsum([len(t) for t in s]).tolist() for s in spelled]
    groups, links, i, j = [], [], 0, 0
    own_a, own_b = [], []
    while i < len(ids_a):
        links.append((ids_a[i], ids_b[j]))
        own_a = own_a if own_a and own_a[-1] == i else own_a + [i]
        own_b = own_b if own_b and own_b[-1] == j else own_b + [j]
        a, b = ends[0][i], ends[1][j]
        i, j = i + (a <= b), j + (b <= a)
        if a == b:
            groups.append(",".join(str(ids_a[k]) for k in own_a) + "|" + ",".join(str(ids_b[k]) for k in own_b))
            own_a, own_b = [], []
    return ids_a, ids_b, ";".join(groups), links


def expected(found, rows):
    made = [(i, *plain_alignment(found, t or "")) for i, t in rows]
    counts = Counter(pair for _, _, _, _, links in made for pair in set(links))
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    out = Counter()
    for i, a, b, groups, links in made:
        digest = hashlib.sha256(groups.encode()).hexdigest() if a else ""
        n_groups = groups.count(";") + 1 if a else 0
        out[i, len(a), len(b), n_groups, len(links), sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links), digest] += 1
    return out


def found_rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_units_give_what_whole_texts_give(libraries, awkward):
    texts = [t or "" for _, t, _ in awkward] + ODD
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *[len(t.encode()) for t in texts]])
    for remembered in (0, 1 << 20):
        found = alignment.Aligner(*alignment.default_paths(), remembered=remembered)
        for _ in range(2):
            made = found.align(data, offsets)
            for k, text in enumerate(texts):
                a, b, groups, links = plain_alignment(libraries, text)
                assert (made.n_a[k], made.n_b[k], made.n_links[k]) == (len(a), len(b), len(links)), text
                assert made.groups[k] == (hashlib.sha256(groups.encode()).hexdigest() if a else "")
                assert sorted(made.pairs[made.pair_text == k].tolist()) == sorted(x * found.size_b + y for x, y in links)


@pytest.mark.parametrize("small", [False, True])
def test_alignment_against_brute_force(spark, docs, awkward, libraries, small, monkeypatch):
    rows = [(i, t) for i, t, _ in awkward]
    if small:
        # Many segments, several levels of merges, blocks of a few keys and lots of two runs.
        monkeypatch.setattr(spill_counts, "FAN_IN", 2)
        rows = rows[:12] + [(100 + k, t) for k, t in enumerate(ODD)]
        docs = spark.createDataFrame([(i, t, "x", "x") for i, t in rows], "doc_id long, text string, segment string, radix string").repartition(6)
    assert found_rows(spill_counts.align(docs)) == expected(libraries, rows)


def test_an_empty_table_and_one_without_tokens(spark, empty):
    assert spill_counts.align(empty).count() == 0
    none = spark.createDataFrame([(1, None), (1, None), (None, "")], "doc_id long, text string")
    assert found_rows(spill_counts.align(none)) == {(1, 0, 0, 0, 0, 0, 0, ""): 2, (None, 0, 0, 0, 0, 0, 0, ""): 1}


def test_runs_merge_in_order_whatever_their_blocks(monkeypatch):
    rng = np.random.default_rng(4)
    monkeypatch.setattr(spill_counts, "BLOCK", 3)
    runs, total = [], Counter()
    for n in (1, 5, 40, 200, 3, 3):
        keys = np.unique(rng.integers(0, 150, n))
        counts = rng.integers(1, 9, len(keys))
        total.update(dict(zip(keys.tolist(), counts.tolist())))
        runs.append(spill_counts.in_blocks(keys, counts))
    keys, counts = map(np.concatenate, zip(*spill_counts.merged(runs)))
    assert (np.diff(keys) > 0).all() and dict(zip(keys.tolist(), counts.tolist())) == total
    keys, counts, best = map(np.concatenate, zip(*spill_counts.with_maxima(spill_counts.merged(runs), 10)))
    tops = defaultdict(int)
    for k, n in total.items():
        tops[k // 10] = max(tops[k // 10], n)
    assert dict(zip(keys.tolist(), best.tolist())) == {k: n == tops[k // 10] for k, n in total.items()}


def test_long_texts_are_counted_in_stretches(monkeypatch):
    rng = np.random.default_rng(5)
    pairs, text = rng.integers(0, 50, 1000), np.repeat(np.arange(10), 100)
    whole = [c.tolist() for c in spill_counts._places(pairs, text)]
    monkeypatch.setattr(spill_counts, "CHUNK_PAIRS", 64)
    assert [c.tolist() for c in spill_counts._places(pairs, text)] == whole
