import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, Score string, block int, fingerprint string"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """Texts with copies, near copies, shared passages, ties, nulls, empties, and a very long one."""
    rng = random.Random(5)
    base = [prose(rng, rng.randint(20, 120)) for _ in range(30)]
    passage = prose(rng, 60)
    out = [*base, *base[:6], base[7] + " tail", "Zz " + base[8], None, None, "", "   \n", "one", "One", "é ß 漢字   x", "a" * 700, "ab " * 300]
    out += [f"{prose(rng, 10)} {passage} {prose(rng, 10)}" for _ in range(5)]
    out += [prose(rng, 9000), base[0].upper()]
    return out


@pytest.fixture(scope="session")
def rows(texts):
    langs, sources = ["en", "fr", None], ["s0", "s1", "s2", None, "s0", "s0"]
    return [(i * 3 - 5, t, langs[i % 3], sources[i % 6], None if t is None else len(t), "x", 1, "y") for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The texts with columns whose names the operators use themselves."""
    return spark.createDataFrame(rows, SCHEMA).repartition(3).persist()


@pytest.fixture(scope="session")
def odd(spark, rows):
    """Null and repeated ids, repeated rows."""
    return spark.createDataFrame([*rows[:12], *rows[:3], (None, rows[2][1], "en", "s0", 1, "x", 1, "y"), (None, None, None, None, None, None, None, None), (rows[4][0], rows[5][1], "en", "s1", 1, "x", 1, "y")], SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
