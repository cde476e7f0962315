import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, row_key int, quality string, word string, n int, block int"


def prose(seed: int, words: int, stems: str = "ab cd efg hij klm no pqr st uvw xyz") -> str:
    rng = random.Random(seed)
    parts = stems.split()
    return " ".join(rng.choice(parts) + rng.choice(parts) + rng.choice(parts) for _ in range(words))


def row(doc_id, text, lang="en"):
    """A document with extra columns whose names the operators use inside."""
    return (doc_id, text, lang, "src", len(text or ""), "x", 1, "y", "z", 2, 3)


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty and blank texts, repeated rows, copies, one very long text."""
    a = prose(1, 80)
    return [
        row(1, a),
        row(1, a),  # the whole row again
        row(2, a),  # a copy
        row(None, a, None),
        row(None, None, None),
        row(3, None),
        row(4, ""),
        row(5, " \n\t "),
        row(6, "Ein Wort — ‹é› 日本語   \x1c ?"),
        row(7, prose(2, 60_000)),
        row(8, "la " * 4000),
    ]


@pytest.fixture()
def edge_docs(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SCHEMA).repartition(3)


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
