from __future__ import annotations

import random

import pytest

from obslake.llm.scratch import prepare

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def prepared(spark):
    return prepare(spark)


def sentence(seed: int, n: int, words: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def awkward_documents() -> list[tuple]:
    """Nulls in every column, blank and long texts, ties and repeated rows."""
    long = sentence(1, 3000)
    return [
        (1, None, "en", "a", 0),
        (2, "", None, "a", None),
        (3, " \t\n\x0b\x0c\r", "en", None, 6),
        (None, "a text without an id", "en", "b", 20),
        (None, None, None, None, None),
        (4, long, "en", "a", len(long)),
        (5, long.upper(), "en", "b", len(long)),
        (6, sentence(2, 120), "en", "b", 1),
        (6, sentence(2, 120), "en", "b", 1),
        (7, sentence(2, 119) + " end", "en", None, 1),
        (8, "one", "en", "c", 3),
        (9, "é ß one\ntwo\ntwo\n\n", "fr", "c", 3),
    ]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_documents(), DOCUMENTS)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def clashing(awkward):
    """The same rows with columns named like those the operators add."""
    from pyspark.sql import functions as F

    names = "size shard slot kept n_words component_id copies benchmark_matches digest spans n __key __tie __doc_id __source __copies __copy __digest row text_ base_failed"
    return awkward.withColumns({name: F.lit("x") for name in names.split()})
