"""Each stage against plain Python, then the whole run."""

import math
from collections import Counter, defaultdict

import corpus_pipeline as pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from flowbook.llm import entropy_balancing, ngram_quality
from flowbook.session import computed_once

from .test_repeats_and_joins import brute, shingles
from .test_scores_and_search import WORD, statistics
from .test_tokens_and_packing import check_pieces, encoded

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, source string, lang string, n_chars long, th long, size long, _h long, `row` string"


def stored(folder, spark, rows):
    spark.createDataFrame(rows, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def labels_dir(spark, tmp_path_factory):
    return stored(tmp_path_factory.mktemp("tables"), spark, [(1, 1, 0), (2, 0, 0)])


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, "en", len(t or ""), 1, 2, 3, "x") for i, t, s in rows], SCHEMA).repartition(3)


def identity(df):
    return Counter((r.doc_id, r.text, r.source) for r in df.collect())


def test_stages_keep_the_columns_of_documents(spark, docs, empty, labels_dir):
    for start in (docs, empty):
        left = start
        for name, stage in pipeline.STAGES[:-1]:
            left = computed_once(stage(spark, left, labels_dir), name)
            assert left.columns == docs.columns and left.schema == docs.schema
        packed = pipeline.packing(spark, left, labels_dir)
        assert (packed.count() > 0) == (start is docs)
        kept = left.where("doc_id IS NOT NULL").first()
        assert start is empty or (kept.th, kept.size, kept._h, kept.row) == (1, 2, 3, "x")


def test_quality_drops_exactly_what_the_rules_and_the_threshold_drop(spark, tmp_path):
    rng = np.random.default_rng(3)
    clean, junk = [f"w{k}" for k in range(80)], [f"J{k}" for k in range(60)]
    rows = []
    for k in range(400):
        own = junk if k % 5 == 0 else clean
        mixed = [*rng.choice(own, 60), *rng.choice(clean if k % 2 else junk, 12)]
        rows.append((k, " ".join(mixed), f"s{k % 3}"))
    rows += [(500, None, None), (501, "", "s"), (502, "a b c", "s"), (503, "x y z u v " * 20, "s"), rows[7], rows[5], (7, rows[5][1], "s"), (None, rows[8][1], "s")]
    labels = [(k, int(k % 5 != 0), 0) for k in range(0, 400, 2)]
    df = frame(spark, rows)
    fit_rows = spark.createDataFrame(labels, "doc_id long, q int, t int").where("q = 1").where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0).collect()
    fit = {r.doc_id for r in fit_rows}
    parts = [(i, (ws := WORD.findall(t or "")), [*ws, *zip(ws, ws[1:])]) for i, t, _ in rows]
    raw, good = Counter(g for *_, gs in parts for g in gs), Counter(g for i, _, gs in parts if i in fit for g in gs)
    share, pseudo = sum(good.values()) / sum(raw.values()), ngram_quality.PSEUDO
    ratio = {g: math.log((good[g] + pseudo) / (n * share + pseudo)) for g, n in raw.items()}
    scores = [sum(ratio[g] for g in gs) / len(gs) if gs else None for *_, gs in parts]
    kind = {i: q == 1 for i, q, _ in labels}
    bins = defaultdict(lambda: [0, 0])
    for (i, *_), score in zip(parts, scores):
        if i in kind and i not in fit and score is not None:
            bins[math.floor(max(min(score, ngram_quality.RANGE), -ngram_quality.RANGE) / ngram_quality.STEP)][kind[i]] += 1
    best, limit, lost, caught = 0.0, -math.inf, 0, 0
    total = [sum(b[k] for b in bins.values()) for k in (0, 1)]
    for place in sorted(bins):
        if lost / total[1] <= 1 - ngram_quality.KEEP_TRUSTED and caught / total[0] - lost / total[1] > best:
            best, limit = caught / total[0] - lost / total[1], place * ngram_quality.STEP
        caught, lost = caught + bins[place][0], lost + bins[place][1]
    want = Counter()
    for (i, t, s), score in zip(rows, scores):
        n, *_, repeated = statistics(t)
        if n >= 10 and 100 * repeated <= 20 * n and score >= limit:
            want[i, t, s] += 1
    assert limit > -math.inf and 300 < sum(want.values()) < 350
    assert identity(pipeline.quality(spark, df, stored(tmp_path, spark, labels))) == want


def test_one_document_of_each_class_stays(spark, docs, awkward, labels_dir):
    sets = [shingles(t) for _, t, _ in awkward]
    classes = list(range(len(awkward)))
    for a in range(len(awkward)):
        for b in range(a):
            if sets[a] and sets[b] and 9 * len(sets[a] & sets[b]) >= 4 * (len(sets[a]) + len(sets[b])):
                old, new = classes[a], classes[b]
                classes = [new if c == old else c for c in classes]
    left = identity(pipeline.near_duplicates(spark, docs, labels_dir))
    wordless = Counter(row for row, s in zip(awkward, sets) if not s)
    assert Counter({row: n for row, n in left.items() if not shingles(row[1])}) == wordless
    stay = Counter({row: n for row, n in left.items() if shingles(row[1])})
    known = {}
    for row, c, s in zip(awkward, classes, sets):
        if s:
            known.setdefault(c, []).append(row)
    assert sum(stay.values()) == len(known)
    for members in known.values():
        ids = [i for i, _, _ in members if i is not None]
        first = min(ids) if ids else None
        assert sum(stay[row] for row in set(members)) == 1
        assert next(row for row in set(members) if stay[row])[0] == first


def test_repeated_passages_are_cut_word_by_word(spark, docs, awkward, labels_dir):
    want = Counter()
    for (i, t, s), (_, ws, keep) in zip(awkward, brute(awkward, "words", 50)):
        if keep.all():
            want[i, t, s] += 1
        elif keep.any():
            want[i, b" ".join(w for w, k in zip(ws, keep) if k).decode(), s] += 1
    made = pipeline.repeated_passages(spark, docs, labels_dir)
    assert identity(made) == want
    assert all(r.n_chars == len(r.text or "") for r in made.collect())


def test_mixing_repeats_whole_documents(spark, labels_dir):
    rows = [(k, "w " * (k % 37), f"s{k % 3}") for k in range(900)] + [(901, None, None), (902, "x y", None), (902, "x y", None)]
    df = frame(spark, rows)
    got = identity(pipeline.mixing(spark, df, labels_dir))
    targets, rates, words = {}, {}, Counter()
    for r in entropy_balancing.mix(df).collect():
        targets[r.source], rates[r.doc_id, r.text, r.source] = r.target, r.rate
    for (i, t, s), n in got.items():
        words[s] += n * len(WORD.findall(t or ""))
        assert math.floor(rates[i, t, s]) <= n / Counter(rows)[i, t, s] <= math.ceil(rates[i, t, s])
    assert set(got) <= set(rows) and all(abs(words[s] - targets[s]) <= 40 for s in targets)
    decided = Counter()
    for r in entropy_balancing.mix(df).collect():
        decided[r.doc_id, r.text, r.source] += r.copies
    assert got == +decided


def test_packing_takes_every_token_once(spark, docs, awkward, labels_dir):
    rows = pipeline.packing(spark, docs, labels_dir).collect()
    check_pieces(rows, awkward, 4096)
    pieces = Counter()
    for r in rows:
        pieces[r.doc_id] += r.length
    want = Counter()
    for (i, _, _), e in zip(awkward, encoded(awkward)):
        want[i] += len(e)
    assert pieces == want


def test_run_on_the_small_tables(spark):
    pieces = pipeline.run(spark, SF)
    sums = pieces.groupBy("sequence_id").sum("length").collect()
    last = max(r["sequence_id"] for r in sums)
    assert all(r["sum(length)"] == 4096 for r in sums if r["sequence_id"] != last)
