import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, leak string, found string, text_key string, spans string, hits string, rank int, Words string"


def prose(seed, words, vocabulary=400):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abcdefghilmnoprstuv") for _ in range(rng.randint(2, 8))) for _ in range(vocabulary)]
    out = []
    for i in range(words):
        out.append(rng.choice(stems) + rng.choice(["", "", "", ",", ".", ".\n"]))
    return " ".join(out)


def row(doc_id, text, lang="en", source="src0"):
    return (doc_id, text, lang, source, None if text is None else len(text), 7, "leak", "found", "key", "spans", "hits", 3, "words")


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in any column, empty, blank and very long texts, ties, repeated rows."""
    same = prose(1, 120)
    return [
        row(1, same),
        row(1, same),
        row(2, same, source=None),
        row(3, None),
        row(4, ""),
        row(5, " \n\t "),
        row(None, prose(2, 50)),
        row(None, None, None, None),
        row(6, prose(3, 200_000)),
        row(7, "one"),
        row(8, "Ünïcode \U0001f600 wörds " * 20, None),
        row(9, "12345 -- 67890"),
        row(10, prose(4, 300) + "   \x1c x  y   z \n \n end "),
        row(11, prose(5, 60), "fr"),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, sf):
    return {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
