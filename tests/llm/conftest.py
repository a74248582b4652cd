"""Small tables for the document operators."""

from __future__ import annotations

import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "n_words int, fingerprint string, component_id string, length int, score string, ids string"
)


def sentence(source: random.Random, words: int) -> str:
    letters = "abcdefghij"
    return " ".join(
        "".join(source.choice(letters) for _ in range(source.randint(2, 6))) for _ in range(words)
    )


def row(doc_id, text, lang="en", host="h0"):
    return (doc_id, text, lang, host, len(text or ""), 1, "x", "y", 2, "z", "w")


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and blank texts, a very long one, repeats, reused ids."""
    source = random.Random(5)
    base = sentence(source, 60)
    return [
        row(1, base),
        row(2, base),
        row(2, base),
        row(2, sentence(source, 40)),
        row(3, None),
        row(4, ""),
        row(5, " \t\n\x0b\x0c\r "),
        row(6, "one"),
        row(7, "One  TWO\nthree"),
        row(8, sentence(source, 30_000)),
        row(9, "x" * 70_000),
        row(None, sentence(source, 25), None, None),
        row(None, None, None, None),
        row(10, base.upper() + "\n" + base, None, None),
        row(11, "été Straße 日本語 ​ ' don't \U0001f600 12345", "fr", "h1"),
        (12, None, None, None, None, None, None, None, None, None, None),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
