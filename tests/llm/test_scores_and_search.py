import math
import re
from collections import Counter

import numpy as np
import pytest

from flowbook.llm import entropy_balancing, host_reputation, ngram_quality, stable_projection_nn, trie_counts
from flowbook.llm.queries import RULES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def statistics(text):
    ws = WORD.findall(text or "")
    grams = Counter(tuple(ws[i:i + 5]) for i in range(len(ws) - 4))
    covered = {k for i in range(len(ws) - 4) if grams[tuple(ws[i:i + 5])] > 1 for k in range(i, i + 5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def test_base_statistics(spark, docs, empty, awkward):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = ngram_quality.judge(docs, labels).collect()
    got = sorted((repr(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in found)
    want = []
    for i, t, _ in awkward:
        s = statistics(t)
        failed = s[0] < 10 or 100 * s[4] > 20 * s[0]
        want.append((repr(i), *s, failed, not failed))  # without labels only the base rules drop
    assert got == sorted(want)
    assert ngram_quality.judge(empty, labels).count() == 0


def test_ratio_parts_junk_from_trusted_text(spark):
    rng = np.random.default_rng(1)
    clean, junk = [f"w{k}" for k in range(60)], [f"J{k}" for k in range(60)]
    rows = [(k, " ".join(rng.choice(junk if k % 5 == 0 else clean, 80))) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 5 != 0), 0) for k in range(0, 400, 2)] + [(None, 1, 0), (3, None, 1)], "doc_id long, quality int, toxic int")
    found = ngram_quality.judge(docs, labels).collect()
    assert all(r.kept == (r.doc_id % 5 != 0) for r in found)
    again = {r.doc_id: r.score for r in ngram_quality.judge(docs.repartition(5), labels).collect()}
    assert again == {r.doc_id: r.score for r in found}


def test_scores_are_mean_log_ratios(spark, docs):
    counts = ngram_quality.counted(docs, docs.where("doc_id % 2 = 0").select("doc_id"))
    rows = counts.collect()
    total = sum(r.raw for r in rows)
    words = sum(statistics(r.text)[0] for r in docs.collect())
    pairs = sum(max(statistics(r.text)[0] - 1, 0) for r in docs.collect())
    assert total == words + pairs and all(r.target <= r.raw for r in rows)


@pytest.mark.parametrize("part_grams", [1 << 21, 3000])
def test_every_ngram_has_its_own_counts(spark, monkeypatch, part_grams):
    monkeypatch.setattr(ngram_quality, "PART_GRAMS", part_grams)
    rng = np.random.default_rng(2)
    texts = [" ".join(f"w{int(w)}" for w in np.minimum(rng.zipf(1.2, 900), 10**9)) for _ in range(120)]
    rows = [*enumerate(texts), (5, texts[5]), (5, texts[6]), (None, texts[7]), (None, texts[7]), (None, None), (200, "w1"), (201, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    fit = set(range(0, 120, 3))
    parts = [(i, (ws := WORD.findall(t or "")), [*ws, *zip(ws, ws[1:])]) for i, t in rows]
    raw, good = Counter(g for _, _, gs in parts for g in gs), Counter(g for i, _, gs in parts if i in fit for g in gs)
    share = sum(good.values()) / sum(raw.values())
    ratio = {g: math.log((good[g] + ngram_quality.PSEUDO) / (n * share + ngram_quality.PSEUDO)) for g, n in raw.items()}
    want = sorted((repr(i), len(ws), sum(ratio[g] for g in gs) / len(gs) if gs else -9.0) for i, ws, gs in parts)
    target = spark.createDataFrame([(i,) for i in fit], "doc_id long")
    got = sorted((repr(r.doc_id), r.n_words, -9.0 if r.score is None else r.score) for r in ngram_quality.score(docs, target).collect())
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert all(math.isclose(g[2], w[2], abs_tol=1e-7) for g, w in zip(got, want))
    keys = ngram_quality.frequent(docs)
    counts = {r.place: (r.raw, r.target) for r in ngram_quality.counted(docs, target, keys).collect()}
    assert 0 < counts[-1][0] < sum(raw.values())  # both ways are taken


def test_token_counts_against_the_library(spark, docs, empty, awkward):
    from tokenizers import Tokenizer
    from tokenizers.models import Unigram

    vocabulary = trie_counts.vocabulary(trie_counts.default_path())
    model = Tokenizer(Unigram([("<unk>", 0.0), *vocabulary.items()], unk_id=0))

    def count(text):
        n = 0
        for word in WORD.findall(text or ""):
            marked = "▁" + word
            found = model.encode(marked)
            n += sum(len(marked[a:b].encode()) if i == 0 else 1 for i, (a, b) in zip(found.ids, found.offsets))
        return n

    got = sorted((repr(r.doc_id), r.n_words, r.n_tokens) for r in trie_counts.token_counts(docs).collect())
    assert got == sorted((repr(i), len(WORD.findall(t or "")), count(t)) for i, t, _ in awkward)
    assert trie_counts.token_counts(empty).count() == 0


def test_shared_prefixes_change_nothing():
    scores = {"a": -1.0, "ab": -1.5, "abc": -4.0, "b": -2.0, "c": -0.5, "bc": -1.8}
    shared = trie_counts.Forward(scores)
    for word in sorted(["a", "ab", "abc", "abca", "abd", "b", "bcbc", "ccc", "é"]):
        assert shared.step(word) == trie_counts.Forward(scores).step(word)


def exact(rows, k=20):
    ids, vectors = [i for i, _ in rows], np.array([v for _, v in rows], float)
    out = {}
    for i, v in set((i, tuple(v)) for i, v in rows if i % 20 == 0):
        scores = (vectors * np.array(v)).sum(axis=1)
        order = sorted((-s, j) for s, j in zip(scores.tolist(), ids) if j != i)[:k]
        out[i] = [(j, -s) for s, j in order]
    return out


@pytest.mark.parametrize("rows_per_group, cell", [(8192, 4096), (60, 50)])
def test_search_against_brute_force(spark, monkeypatch, rows_per_group, cell):
    monkeypatch.setattr(stable_projection_nn, "GROUP_ROWS", rows_per_group)
    monkeypatch.setattr(stable_projection_nn, "GROUP_QUERIES", 4)
    monkeypatch.setattr(stable_projection_nn, "CELL_ROWS", cell)
    rng = np.random.default_rng(6)
    rows = [(k, rng.standard_normal(12).round(3).tolist()) for k in range(600)]
    hot = rng.standard_normal(12).tolist()
    rows += [(k, hot) for k in range(600, 760)]
    odd = [(1000, None), (1020, [0.0] * 12), (1040, [float("nan")] * 12), (1060, [1.0] * 11 + [None]), (1080, [1.0] * 5), (None, [1.0] * 12), (1100, []), rows[3]]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows + odd], "vec_id long, embedding array<double>, score int")
    got = {}
    for r in stable_projection_nn.search(df).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = exact(rows)
    assert set(got) == set(want)
    hits = sum(len({j for j, _ in got[q]} & {j for j, _ in want[q]}) for q in want)
    assert hits >= 0.97 * sum(map(len, want.values()))
    assert [j for j, _ in got[600]][:19] == [j for j, _ in want[600]][:19]  # ties go to the smaller id
    assert all(math.isclose(s, dict(want[q]).get(j, s), abs_tol=1e-12) for q in got for j, s in got[q])


def test_search_of_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [-1.0, 0.0])], "vec_id long, embedding array<float>")
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in stable_projection_nn.search(df).orderBy("rank").collect()] == [(0, 1, 1, 1.0), (0, 2, 2, -1.0)]
    assert stable_projection_nn.search(df.limit(0)).count() == 0


def test_every_length_and_every_row_is_answered(spark, monkeypatch):
    monkeypatch.setattr(stable_projection_nn, "CELL_ROWS", 50)
    rng = np.random.default_rng(8)
    kinds = {d: [(k, rng.standard_normal(d).round(3).tolist()) for k in range(start, start + n)] for d, start, n in ((6, 0, 240), (9, 240, 160), (3, 400, 30))}
    kinds[6] += [(20, rng.standard_normal(6).tolist()), (20, rng.standard_normal(6).tolist())]  # two more rows of one id
    df = spark.createDataFrame([r for rows in kinds.values() for r in rows], "vec_id long, embedding array<double>").repartition(3)
    got = {}
    for r in stable_projection_nn.search(df).collect():
        got.setdefault((r.query_id, r["rank"]), []).append((r.score, r.vec_id))
    want = {}
    for rows in kinds.values():
        for i, v in rows:
            if i % 20 == 0:
                best = sorted((-float(np.dot(v, w)), j) for j, w in rows if j != i)[:20]
                for rank, (s, j) in enumerate(best, 1):
                    want.setdefault((i, rank), []).append((-s, j))
    assert {q: len(x) for q, x in got.items()} == {q: len(x) for q, x in want.items()}
    hits = sum(len({j for _, j in got[q]} & {j for _, j in want[q]}) for q in want)
    assert hits >= 0.9 * sum(len({j for _, j in x}) for x in want.values())


def test_the_search_stops_before_the_end(spark):
    """Most vectors of clustered tables, and a good part of unclustered ones, are never verified; recall stays."""
    rng = np.random.default_rng(11)
    for spread, most in ((0.3, 0.2), (3.0, 0.9)):  # the second: spread evenly, at a confidence of 0.999
        centres = rng.standard_normal((20, 64))
        v = centres[np.arange(4000) % 20] + spread * rng.standard_normal((4000, 64))
        v /= np.linalg.norm(v, axis=1)[:, None]
        axes = rng.standard_normal((65, stable_projection_nn.M))
        points, ids, hits, seen = v @ axes[:-1], np.arange(4000), 0, 0
        for q in range(0, 4000, 200):
            far = ((points - v[q] @ axes[:-1]) ** 2).sum(axis=1)
            found, _, verified = stable_projection_nn._nearest(q, v[q], -np.inf, far, np.zeros(4000), ids, v, 20, 1.0)
            hits += len(set(found.tolist()) & set(np.argsort(-(v @ v[q]) + 9.0 * (ids == q))[:20].tolist()))
            seen += verified
        assert hits >= 0.95 * 20 * 20 and seen < most * 20 * 4000


def test_hot_vectors_are_cut_before_the_shuffle(spark):
    df = spark.createDataFrame([(k, [1.0, float(k % 3 == 0)]) for k in range(90)], "vec_id long, embedding array<double>").repartition(4)
    few = stable_projection_nn.few_of_each(df, 4)
    assert sorted(r.vec_id for r in few.collect()) == sorted([*range(0, 15, 3), 1, 2, 4, 5, 7])
    plan = few._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_chi_square():
    assert math.isclose(stable_projection_nn.chi_square_cdf(15.507, 8), 0.95, abs_tol=1e-4)
    assert math.isclose(stable_projection_nn.chi_square_quantile(0.95, 32), 46.194, abs_tol=1e-2)
    assert math.isclose(stable_projection_nn.chi_square_quantile(0.95, 8), 15.507, abs_tol=1e-3)


def test_addresses_and_rules(spark):
    urls = ["https://A.Example.ORG/es/x?y", "http://example.org/en/12#t", "x://b.com", "nothing", None, "http://c.com?/fr/", "http://fr.com/fr/q", "HTTP://Ünder.NET/p\nq", "a://b://c/d", ""]
    df = spark.createDataFrame([(k, u, 9) for k, u in enumerate(urls)] + [(0, urls[0], 9)], "page_id long, url string, host int")
    outcomes = spark.createDataFrame([(0, True), (0, False), (2, None), (None, True)], "page_id long, good boolean")
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in host_reputation.judge(df, outcomes, RULES).collect()}
    want = {
        (0, "a.example.org", "/es/x", "example.org/es/", "block"), (1, "example.org", "/en/12", "example.org/en/1", "block"), (2, "b.com", "", None, "allow"),
        (3, "", "", None, "allow"), (4, "", "", None, "allow"), (5, "c.com", "", None, "allow"), (6, "fr.com", "/fr/q", "com/fr/", "allow"),
        (7, "Ünder.net", "/p\nq", None, "allow"), (8, "b:", "//c/d", None, "allow"), (9, "", "", None, "allow"),
    }
    assert got == want
    assert host_reputation.judge(df.limit(0), outcomes.limit(0), RULES).count() == 0


def test_a_bad_host_is_blocked_and_a_small_one_is_shrunk(spark):
    pages = [(k, f"http://h{k % 4}.site{k % 2}.net/") for k in range(400)] + [(400, "http://new.site0.net/"), (401, "http://one.net/")]
    good = [(k, k % 4 != 0 or k % 40 == 0) for k in range(400)] + [(401, False)]
    df = spark.createDataFrame(pages, "page_id long, url string")
    found = {r.host: r for r in host_reputation.judge(df, spark.createDataFrame(good, "page_id long, good boolean"), ()).collect()}
    assert found["h0.site0.net"].verdict == "block" and found["h1.site1.net"].verdict == "allow"
    assert found["one.net"].verdict == "allow"  # one bad page is not enough
    assert found["new.site0.net"].host_mean < found["h1.site1.net"].host_mean  # its domain has a bad host


def test_levels_of_hosts(spark):
    hosts = ["a.co.uk", "x.b.co.uk", "co.uk", "u@x.com:8080", "www.x.com", "10.0.0.1:80", "[::1]:8080", "", "localhost", "me.github.io", "b:", "k.www.ck"]
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    table = spark.createDataFrame([("CO.UK",), ("github.io",), ("co.uk",), (None,), ("www.ck",)], "suffix string")
    got = {r.host: (r.domain, r.suffix) for r in host_reputation.levels(df, table).collect()}
    assert got == {
        "a.co.uk": ("a.co.uk", "co.uk"), "x.b.co.uk": ("b.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "u@x.com:8080": ("x.com", "com"), "www.x.com": ("x.com", "com"),
        "10.0.0.1:80": ("10.0.0.1", "10.0.0.1"), "[::1]:8080": ("[::1]", "[::1]"), "": ("", ""), "localhost": ("localhost", "localhost"), "me.github.io": ("me.github.io", "github.io"),
        "b:": ("b", "b"), "k.www.ck": ("k.www.ck", "www.ck"),
    }
    plain = {r.host: (r.domain, r.suffix) for r in host_reputation.levels(df).collect()}
    assert plain["a.co.uk"] == ("co.uk", "uk") and plain["10.0.0.1:80"] == ("10.0.0.1", "10.0.0.1") and plain["u@x.com:8080"] == ("x.com", "com")


def test_sites_below_one_public_suffix_do_not_share_a_domain(spark):
    pages = [(k, f"http://{'bad' if k < 200 else 'fine'}.co.uk/{k}") for k in range(400)] + [(k, f"http://s{k % 9}.com:{k}/") for k in range(400, 500)] + [(500, "http://new.co.uk/")]
    df = spark.createDataFrame(pages, "page_id long, url string")
    outcomes = spark.createDataFrame([(k, k >= 200) for k in range(500)], "page_id long, good boolean")
    suffixes = spark.createDataFrame([("co.uk",)], "suffix string")
    found = {r.host: r for r in host_reputation.judge(df, outcomes, (), public_suffixes=suffixes).collect()}
    assert found["bad.co.uk"].verdict == "block" and found["fine.co.uk"].verdict == "allow" and found["new.co.uk"].verdict == "allow"
    known = host_reputation.reputation(spark.createDataFrame([("bad.co.uk", False), ("fine.co.uk", True)], "host string, good boolean"), public_suffixes=suffixes)
    assert {r.domain for r in known.collect()} == {"bad.co.uk", "fine.co.uk"}


def test_water_filling(spark):
    df = spark.createDataFrame([("b", 10), ("a", 100), ("c", 1000), (None, 0), ("d", 50)], "source string, source_size long")
    got = {r.source: r.target for r in entropy_balancing.targets(df).collect()}
    sizes, weights = {"a": 100, "b": 10, "c": 1000, "d": 50, None: 0}, {"a": 3, "b": 1, "c": 2, "d": 3, None: 1}
    want, full = {}, set()
    while True:
        left = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in full)
        share = {s: left * weights[s] / sum(weights[x] for x in sizes if x not in full) for s in sizes if s not in full}
        over = {s for s in share if share[s] > 2 * sizes[s]}
        if not over:
            break
        full |= over
    want = {**{s: 2.0 * sizes[s] for s in full}, **share}
    assert all(math.isclose(got[s], want[s], abs_tol=1e-9) for s in sizes)


def test_newton_against_a_dense_solver(spark):
    """The multipliers of the dual, against many small gradient steps in plain Python."""
    rng = np.random.default_rng(6)
    cells = [([f"s{a}", f"l{b}", f"n{c}"], float(rng.integers(1, 400))) for a in range(3) for b in range(2) for c in range(4) if rng.random() < 0.9]
    hard = {f"s{a}": sum(w for g, w in cells if g[0] == f"s{a}") * f for a, f in enumerate((0.4, 1.3, 1.9))}
    everything, wanted = sum(w for _, w in cells), sum(hard.values())
    soft = {g: wanted * sum(w for own, w in cells if g in own) / everything for g in ("l0", "l1", "n0", "n1", "n2", "n3")}
    found = entropy_balancing.multipliers(spark.createDataFrame(cells, "groups array<string>, words double"), hard, soft, 2.0)
    at = dict.fromkeys(found, 0.0)
    goal = {**hard, **soft}
    for _ in range(60_000):
        taken = dict.fromkeys(at, 0.0)
        for own, w in cells:
            rate = min(2.0, math.exp(sum(at[g] for g in own)))
            for g in own:
                taken[g] += w * rate
        for g in at:
            at[g] += 0.05 * (1 - taken[g] / goal[g] - (entropy_balancing.PENALTY * at[g] if g in soft else 0))
    # One direction of the multipliers of capped cells is flat, so rates are compared.
    for own, w in cells:
        rates = [min(2.0, math.exp(sum(m[g] for g in own))) for m in (found, at)]
        assert math.isclose(*rates, abs_tol=1e-4)
    with pytest.raises(ArithmeticError):
        entropy_balancing.multipliers(spark.createDataFrame(cells, "groups array<string>, words double"), {"s0": 1e9}, {}, 2.0, rounds=5)


def test_rates_differ_inside_a_source_and_keep_the_languages(spark):
    rows = []
    for k in range(1200):
        source, lang = "abc"[k % 3], "en" if k % 3 == 1 and k % 5 else "fr" if k % 7 else None
        rows.append((k, "w " * (5 + k % 90), source, lang))
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    with_, without = (entropy_balancing.mix(df, balance=b).collect() for b in (("lang",), ()))
    assert len({round(r.rate, 9) for r in with_ if r.source == "b"}) > 2

    def share(found, lang):
        return sum(r.taken for r in found if r.lang == lang) / sum(r.taken for r in found)

    before = {lang: sum(5 + k % 90 for k, _, _, own in rows if own == lang) / sum(5 + k % 90 for k in range(1200)) for lang in ("en", "fr", None)}
    assert sum(abs(share(with_, lang) - p) for lang, p in before.items()) < sum(abs(share(without, lang) - p) for lang, p in before.items())
    for found in (with_, without):
        for source in "abc":
            mine = [r for r in found if r.source == source]
            assert abs(sum(r.taken for r in mine) - mine[0].target) <= 100 and all(r.taken <= 2 * r.size for r in mine)


def test_mix_meets_targets(spark, docs, empty, awkward):
    rows = [(k, "w " * (k % 37), f"s{k % 3}") for k in range(900)] + [(901, None, None), (902, "x y", None), (902, "x y", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = entropy_balancing.mix(df).collect()
    assert len(found) == len(rows) and all(0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size for r in found)
    for source in ("s0", "s1", "s2"):
        mine = [r for r in found if r.source == source]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 40
        assert math.isclose(sum(r.rate * r.size for r in mine), mine[0].target, rel_tol=1e-6) and all(r.copies in (math.floor(r.rate), math.ceil(r.rate)) for r in mine)
    again = entropy_balancing.mix(df.repartition(7)).collect()
    assert Counter((r.doc_id, r.copies) for r in again) == Counter((r.doc_id, r.copies) for r in found)
    odd = entropy_balancing.mix(docs)
    assert odd.columns == ["doc_id", "text", "source", "lang", "n_chars", "th", "_h", "row", "size", "source_size", "target", "rate", "copies", "taken"]
    assert sorted((repr(r.doc_id), r.size) for r in odd.collect()) == sorted((repr(i), len(WORD.findall(t or ""))) for i, t, _ in awkward)
    assert entropy_balancing.mix(empty).count() == 0
