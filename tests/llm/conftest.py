import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score string, key string"


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and blank texts, a long one, repeated rows, extra columns."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(60)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    shared = prose(60)
    rows = [
        (1, None, "en", "a", None, "x", None),
        (2, "", "en", "a", 0, None, "k"),
        (3, " \t\n ", None, None, 3, "x", "k"),
        (4, "123 456 !!", "de", "a", 10, "x", "k"),
        (None, shared, None, None, None, None, None),
        (5, shared, "en", "b", None, "x", "k"),
        (6, shared, "fr", "b", None, "x", "k"),
        (7, "start " + shared + " end", "en", None, None, "x", "k"),
        (8, shared[:100] + prose(40) + shared[100:], "de", "a", None, "x", "k"),
        (9, prose(30_000), "en", "a", None, "x", "k"),
        (10, "é漢字 ñandú straße " * 40, "fr", "c", None, "x", "k"),
        (11, "aaaa " * 500, "en", "c", None, "x", "k"),
        (12, "one two", "en", "c", None, "x", "k"),
        (12, "one two", "en", "c", None, "x", "k"),
    ]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], COLUMNS)
