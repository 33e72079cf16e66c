import random

import pytest

from headway.llm import quality
from headway.llm.queries import table

ODD = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


@pytest.fixture(scope="session")
def labels(spark, sf_dir):
    return table(spark, sf_dir, "labels")


@pytest.fixture(scope="session")
def quality_model(docs, labels):
    return quality.fit(docs, labels)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, columns that clash."""
    r = random.Random(4)
    words = ["the", "of", "nation", "Straße", "élan", "x" * 700, "漢字", "=====", "12", "and"]
    long_text = " ".join(r.choice(words) for _ in range(40_000))
    rows = [
        (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi", "en", "s", 5),
        (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi", "en", "s", 5),
        (2, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi", None, None, None),
        (3, None, "en", "s", None),
        (4, "", "de", "s", 0),
        (5, " \n\t\r\n ", None, "s", 4),
        (6, long_text, "de", "s", len(long_text)),
        (7, long_text + " end", "de", "s", None),
        (None, "a row without an id, and with words enough for a shingle or two", "en", "s", 1),
        (None, None, None, None, None),
        (8, "!!! 123 ???", "fr", "s", 3),
        (8, "another text of the same id", "fr", "s", 3),
        (9, "z" * 300_000, "fr", "s", 3),
    ]
    df = spark.createDataFrame(rows, ODD)
    clashing = ("chunk bucket key tie part rep n bits component leader line owner lines hashes sizes label start"
                " item_id digest prefix salt removed score ids lines_removed _gone").split()
    return df.selectExpr("*", *(f"'clash' as {c}" for c in clashing))
