import hashlib
import re
from collections import Counter

import pytest

from flowbook.llm import piece_table


def plain_python(doc_id, text, seed=7, rate=100, spm_rate=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    hexed = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(hexed[k:k + 8], 16) for k in range(0, 32, 8))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    if h4 % 100 < spm_rate:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


CASES = [
    (1, None), (2, ""), (3, "\n"), (4, "\n\n\n"), (5, "a\nb\nc\nd\ne"), (6, "a\nb\nc\n"), (7, "no line end"), (8, "x <P> y\nz"), (9, "<S>"), (10, "<<S\nP><\n>S>\nM>\n<"),
    (11, "é\nüß\n😀\n" * 50), (12, "\n".join("line %d é" % k for k in range(30_000))), (None, "a\nb\nc\n"), (-5, "a\nb\nc\n"), (14, "a\r\nb c\x0bd\n"), (5, "a\nb\nc\nd\ne"),
    *[(k, "one\ntwo\nthree\nfour\nfive\nsix") for k in range(100, 160)],
]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([(i, t, t, 1) for i, t in CASES], "doc_id long, text string, output string, n long").repartition(3)


@pytest.mark.parametrize("rate, spm_rate", [(100, 50), (40, 0), (0, 50), (100, 100)])
def test_transform_against_plain_python(table, rate, spm_rate):
    rows = piece_table.transform(table, rate=rate, spm_rate=spm_rate).collect()
    expected = Counter(plain_python(i, t, rate=rate, spm_rate=spm_rate) for i, t in CASES)
    assert Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in rows) == expected
    assert all(r.output_sha256 == hashlib.sha256(r.output.encode()).hexdigest() for r in rows)
    forms = {r.form for r in rows}
    assert forms == ({"plain"} if rate == 0 else {"plain", "psm"} if spm_rate == 0 else {"plain", "spm"} if spm_rate == 100 else {"plain", "psm", "spm"})


def test_pieces_stand_for_the_output(table):
    texts = {(i, t or "") for i, t in CASES}
    for r in piece_table.transform(table).collect():
        matches = []
        for i, text in texts:
            if i == r.doc_id:
                buffers = (text.encode(), b"<P><S><M>")
                matches.append(b"".join(buffers[p.buffer][p.begin:p.begin + p.size] for p in r.pieces) == r.output.encode())
        assert any(matches)


def test_restore_needs_the_output_and_the_form_alone(table, spark):
    made = piece_table.transform(table).select("output", "form", "doc_id")
    back = piece_table.restore(made).collect()
    assert Counter((r.doc_id, r.restored) for r in back) == Counter((i, t or "") for i, t in CASES)
    assert all(r.restored_sha256 == hashlib.sha256(r.restored.encode()).hexdigest() for r in back)
    odd = spark.createDataFrame([(None, None, "x"), ("abc", None, "y")], "output string, form string, restored string")
    assert sorted(r.restored for r in piece_table.restore(odd).collect()) == ["", "abc"]


def test_own_sentinels_and_refused_ones(table):
    own = ("<|fim_prefix|>", "<|fim_suffix|>", "<|fim_middle|>")
    made = piece_table.transform(table, sentinels=own)
    assert {r.form for r in made.where("doc_id = 8 OR doc_id = 9").collect()} <= {"psm", "spm"}
    assert Counter(r.restored for r in piece_table.restore(made, own).collect()) == Counter(t or "" for _, t in CASES)
    for bad in (("ab", "ba", "c"), ("x", "xy", "z"), ("", "b", "c"), ("aba", "d", "e"), ("a", "a", "b"), ("a", "b")):
        with pytest.raises(ValueError):
            piece_table.transform(table, sentinels=bad)


def test_an_empty_table(spark, empty):
    assert piece_table.restore(piece_table.transform(empty)).collect() == []
