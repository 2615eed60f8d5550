import zlib
from collections import Counter

import numpy as np
import pytest

from flowbook.llm import mixture_packing, wavelet
from flowbook.llm.tokens import Encoder, default_path
from flowbook.session import working_folder


def encoded(rows):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(default_path()).encode_batch([t or "" for _, t, _ in rows], add_special_tokens=False)
    return [np.array([*e.ids, 2], "<u4") for e in found]


def test_encoder_gives_the_library_s_ids():
    enc = Encoder(default_path(), remembered=3)
    for texts in (["", "a b", "It's 12ab３, ÉÇÖ. ΣΑΣ"], ["x<|endoftext|>y"], ["a\x1cb\u3000c\x85d"], ["J\u030c I\u0307 e\u0301"]):
        data = np.frombuffer("".join(texts).encode(), np.uint8)
        offsets = np.cumsum([0, *[len(t.encode()) for t in texts]])
        ids, at = enc.encode(data, offsets)
        for k, text in enumerate(texts):
            assert ids[at[k]:at[k + 1]].tolist() == [*enc.tokenizer.encode(text, add_special_tokens=False).ids, 2]


def test_encoder_learns_a_word_once_over_batches(monkeypatch):
    enc, learned = Encoder(default_path()), []
    words = enc._words
    monkeypatch.setattr(enc, "_words", lambda new, plain: learned.extend(new) or words(new, plain))
    for text in ("one two one", "two ONE three", "É one", "four"):
        data = np.frombuffer(text.encode(), np.uint8)
        ids, _ = enc.encode(data, np.array([0, len(data)]))
        assert ids.tolist() == [*enc.tokenizer.encode(text, add_special_tokens=False).ids, 2]
    assert len(learned) == len(set(learned)) and learned.count(b"one") == 1 and learned.count(b"two") == 1


def test_wavelet_matrix_against_the_plain_list():
    rng = np.random.default_rng(3)
    for n in (0, 1, 63, 512, 513, 3000):
        ids = rng.integers(0, 37, n).astype("<u2")
        m = wavelet.WaveletMatrix.build(ids, 6)
        assert m.decode().tolist() == ids.tolist()
        assert [m.access(i) for i in range(0, n, 7)] == ids[::7].tolist()
        for value in (0, 5, 36, 50, 64):
            places = np.flatnonzero(ids == value).tolist()
            assert m.count(value) == len(places) and m.places(value).tolist() == places
            assert [m.select(value, k) for k in range(len(places))] == places
            assert m.count(value, n // 3, n // 2) == sum(n // 3 <= p < n // 2 for p in places)
        with pytest.raises(IndexError):
            m.select(1, n)


def test_shards_round_trip(spark, docs, empty, awkward):
    folder = working_folder(spark, "shards")
    wavelet.write_shards(docs, folder, segment_tokens=300)
    back = wavelet.read_tokens(spark, folder).collect()
    ids = encoded(awkward)
    assert Counter((r.doc_id, bytes(r.ids)) for r in back) == Counter((i, e.tobytes()) for (i, _, _), e in zip(awkward, ids))
    ordered = sorted(back, key=lambda r: r.start)
    assert [r.start for r in ordered] == np.concatenate(([0], np.cumsum([r.n_tokens for r in ordered])[:-1])).tolist()
    known = [r.doc_id for r in ordered]
    assert known == sorted(known, key=lambda k: (k is not None, k))
    rows = spark.read.parquet(folder)
    shard = rows.first()["shard"]
    file = wavelet.ShardFile([r.asDict() for r in rows.where(f"shard = {shard}").collect()])
    inside = np.concatenate([np.frombuffer(r.ids, "<u4") for r in ordered])
    start = rows.where(f"shard < {shard}").groupBy().sum("n").first()[0] or 0
    part = inside[start:start + file.n]
    assert [file.access(i) for i in range(0, file.n, 31)] == part[::31].tolist()
    assert list(file.occurrences(2)) == np.flatnonzero(part == 2).tolist() and file.count(2) == (part == 2).sum()
    none = working_folder(spark, "none")
    wavelet.write_shards(empty, none)
    assert wavelet.read_tokens(spark, none).count() == 0


def test_counts_and_places_over_all_shards(spark, docs, empty):
    folder = working_folder(spark, "found")
    wavelet.write_shards(docs, folder, segment_tokens=300)
    whole = sorted(((r.start, r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in wavelet.read_tokens(spark, folder).collect()), key=lambda r: r[0])
    flat = [x for *_, ids in whole for x in ids]
    values = [2, 2, max(flat), flat[len(flat) // 2], 49_000, -1, 1 << 20]
    assert {r.value: r.n for r in wavelet.count_tokens(spark, folder, values).collect()} == {v: flat.count(v) for v in values}
    want = {(x, start + k, doc, k) for start, doc, ids in whole for k, x in enumerate(ids) if x in values}
    assert {tuple(r) for r in wavelet.find_tokens(spark, folder, values).collect()} == want and len(want) == sum(x in values for x in flat)
    none = working_folder(spark, "none")
    wavelet.write_shards(empty, none)
    assert [tuple(r) for r in wavelet.count_tokens(spark, none, [5]).collect()] == [(5, 0)] and wavelet.find_tokens(spark, none, [5]).count() == 0


def check_pieces(rows, awkward, window):
    total = sum(len(e) for e in encoded(awkward))
    windows = {}
    for r in rows:
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for w, parts in windows.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at == window or (w == max(windows) and at == total - window * w)
    assert sorted(windows) == list(range(len(windows))) and sum(r.length for r in rows) == total


@pytest.mark.parametrize("targets", [None, {"s0": 5, "s1": 1, "s2": 1, None: 1}])
def test_packing_holds_every_id_once_in_target_shares(docs, awkward, targets):
    rows = mixture_packing.pack(docs, targets, window=64).collect()
    check_pieces(rows, awkward, 64)
    texts = Counter()
    for i, e in zip((r[0] for r in awkward), encoded(awkward)):
        texts[i, len(e)] += 1
    joined = {}
    for r in rows:
        joined.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, bytes(r.ids)))
    for (i, n), parts in joined.items():
        assert sum(len(b) for _, b in parts) == 4 * n * texts[i, n]
    shares = Counter()
    for i, t, s in awkward:
        shares[s] += 0
    for (i, t, s), e in zip(awkward, encoded(awkward)):
        shares[s] += len(e)
    if targets is None:
        given = Counter()
        for r in rows:
            given[r.sequence_id, r.source] += r.length
        last = max(r.sequence_id for r in rows)
        for (w, s), n in given.items():
            assert w == last or abs(n - 64 * shares[s] / sum(shares.values())) <= 3
    sequences = mixture_packing.sequences(mixture_packing.pack(docs, targets, window=64)).collect()
    assert all(len(s.ids) == 4 * s.n_tokens for s in sequences)


def test_packing_an_empty_table(empty):
    assert mixture_packing.pack(empty).count() == 0


def test_schedule_never_takes_a_token_back():
    s = mixture_packing.Schedule(np.array([1000, 1, 0, 333, 7]))
    given = s.given(np.arange(s.total + 1))
    assert (np.diff(given, axis=0) >= 0).all() and (given.sum(axis=1) == np.arange(s.total + 1)).all()
    quota = np.arange(s.total + 1)[:, None] * s.totals / s.total
    assert np.abs(given - quota).max() < 2
    for q in (0, 1, 3, 4):
        tokens = np.arange(s.totals[q])
        want = np.searchsorted(given[:, q], tokens, "right") - 1
        assert (s.window_of(q, tokens, 10) == want // 10).all()


def test_windows_are_guessed_not_searched(monkeypatch):
    for totals, weights in (([3_000_000, 1, 900_000, 40_000_000], None), ([3_000_000, 70, 900_000], [1.0, 5.0, 2.0])):
        s = mixture_packing.Schedule(np.array(totals), None if weights is None else np.array(weights))
        for q in range(len(totals)):
            tokens = np.unique(np.linspace(0, totals[q] - 1, 50).astype(np.int64))
            asked = []
            with monkeypatch.context() as m:
                m.setattr(mixture_packing.Schedule, "given", lambda self, at, f=mixture_packing.Schedule.given: asked.append(len(at)) or f(self, at))
                found = s.window_of(q, tokens, 4096)
            assert len(asked) <= 4 or totals[q] < 4096
            assert (s.given(found * 4096)[:, q] <= tokens).all()
            assert (s.given(np.minimum((found + 1) * 4096, s.total))[:, q] > tokens).all()


def test_crc_columns(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(bytearray(b"\x01\x00\x00\x00"),)], "b binary")
    assert df.select(F.crc32("b")).first()[0] == zlib.crc32(b"\x01\x00\x00\x00")


def test_words_of_a_large_batch_are_encoded_once(monkeypatch):
    words = [f"{k:x}".translate(str.maketrans("0123456789", "ghijklmnop")) for k in range(250_000)]
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    enc = Encoder(default_path())
    first, _ = enc.encode(data, np.array([0, len(data)]))
    monkeypatch.setattr(enc, "_words", lambda *_: pytest.fail("a known word is encoded again"))
    again, _ = enc.encode(data, np.array([0, len(data)]))
    assert (first == again).all()
