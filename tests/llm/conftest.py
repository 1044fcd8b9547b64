import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, size string, _id long, key int, copies int, spans string, html int"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text[, lang[, source]]), with columns whose names the operators use themselves."""

    def make(rows):
        full = [(*r, *[None] * (4 - len(r)), 0, 1, "x", 2, 3, 4, "y", 5) for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture
def rng():
    return random.Random(3)


ODD = [(1, None), (2, ""), (3, " \n\t "), (3, " \n\t "), (None, "some words of a text here"), (4, "1234 567"), (5, "one " * 30_000), (6, "é" * 3)]


@pytest.fixture
def odd(docs):
    """NULLs, empty and very long texts, repeated rows."""
    return docs(ODD)


def classes_of(n, pairs):
    """Least reachable number of each of ``n`` nodes."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return [find(i) for i in range(n)]
