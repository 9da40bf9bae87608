"""What several tests of the operators need."""

from __future__ import annotations

import random

import pytest

WORDS = "the of and to in is it was for on that by this with from stone river cloud paper green seven north".split()
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture
def rng() -> random.Random:
    return random.Random(5)


@pytest.fixture
def odd_documents(spark, rng):
    """Nulls in every column, empty and white texts, ties, repeated rows, one long text; clashing extra columns."""
    long = sentence(rng, 30_000)
    rows = [
        (1, sentence(rng, 80), "en", "a", 1),
        (1, sentence(rng, 80), "en", "a", 1),
        (2, None, "en", "a", None),
        (None, sentence(rng, 60), None, None, None),
        (None, None, None, None, None),
        (3, "", "de", "b", 0),
        (4, " \n\t ", "de", None, 3),
        (5, long, "fr", "b", 9),
        (6, long, "fr", "c", 9),
        (6, long, "fr", "c", 9),
        (7, "!!! 12", "fr", "c", 9),
        (8, "one퟿ \U0001f600 two", "es", "c", 9),
    ]
    made = spark.createDataFrame(rows, DOCS)
    names = "size key id row at tie kept score shard slot copies found block taken target class_id contaminated runs".split()
    for name in names:
        made = made.selectExpr("*", f"'mine' AS {name}")
    return made
