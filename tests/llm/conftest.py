"""Small tables with every awkward case: nulls, empty and long texts, ties, repeated rows, clashing extra columns."""

import random

import pytest

SCHEMA = "doc_id long, text string, source string, lang string, n_chars long, th long, size long, _h long, `row` string"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(n))


@pytest.fixture(scope="session")
def awkward():
    rng = random.Random(5)
    base = [words(rng, 120) for _ in range(6)]
    passage = words(rng, 70)
    near = base[0].split()
    near[60] = "changed"
    texts = [
        base[0], base[1], base[0], " ".join(near), base[2] + "\n" + passage + "\n" + base[3], passage, base[4] + " " + passage, None, "", "  \n\t ",
        "one", "two words", base[5] * 40, "a " * 200, "b a " * 150, "é ü ß " * 60 + passage, "line x\nline x\nline y\n", "<|x|> #% it's 12ab Σ", base[1] + " tail",
        "a " * 120, "über " + base[2], "\x0b\x0c x y z",
    ]
    rows = [(i * 3 % 17 + i, t, f"s{i % 3}" if i % 7 else None) for i, t in enumerate(texts)]
    rows += [rows[0], rows[4], (None, base[1], "s0"), (None, None, None), (None, base[0], "s1"), (rows[1][0], base[4], "s2")]
    return rows


@pytest.fixture(scope="session")
def docs(spark, awkward):
    return spark.createDataFrame([(i, t, s, "en", len(t or ""), 1, 2, 3, "x") for i, t, s in awkward], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
