from __future__ import annotations

import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, fingerprint string, bucket int, "
    "n_words long, start long, `odd name` string, _row long, words string")


def table(spark, rows):
    """Documents with further columns whose names clash with those of results."""
    return spark.createDataFrame(
        [(i, t, "en", "s", None if t is None else len(t), 0.5, "f", 1, 2, 3, "x", 4, "w") for i, t in rows], SCHEMA)


@pytest.fixture(scope="session")
def odd_texts():
    """NULL, empty, blank, tiny, odd, repeated and very long texts; NULL and repeated ids."""
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(400)]
    line = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared, long = line(60), line(30_000)
    rows = [
        (1, None), (2, ""), (3, " \t\n\r\x0b\x0c "), (4, "a"), (5, "Été à la plage, ß 日本 😀"), (6, "a" * 5000), (7, "ab " * 3000),
        (8, shared), (9, shared), (9, shared), (10, line(20) + " " + shared + " " + line(20)), (10, line(200)), (None, shared), (None, line(90)),
        (11, long), (12, long + " tail"), (13, "\n".join([line(8)] * 5)), (14, "one\x00two \x1f three"), (15, line(12)), (16, "#*$%&|<> " * 20),
    ]
    return rows + [(20 + k, line(rng.randint(1, 300))) for k in range(60)]


@pytest.fixture(scope="session")
def odd(spark, odd_texts):
    return table(spark, odd_texts).repartition(5).cache()


@pytest.fixture(scope="session")
def none(spark):
    return table(spark, [])


@pytest.fixture(scope="session")
def labels(spark, odd_texts):
    rows = [(i, k % 2, int(k % 3 == 0)) for k, (i, _) in enumerate(odd_texts)] + [(None, 1, 1), (999, 0, 1), (20, None, None), (21, 0, 1), (21, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
