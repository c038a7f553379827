"""Small tables with the awkward rows that every operator must take."""

import pytest

LONG = " ".join(f"w{i}" for i in range(30_000))


@pytest.fixture(scope="session")
def awkward(spark):
    """NULLs in every column, empty and very long texts, ties, repeats, clashing names."""
    prose = " ".join(f"word{i % 37} thing{i % 11} of the" for i in range(60))
    rows = [
        (1, prose, "en", "a", 5),
        (1, prose, "en", "a", 5),
        (1, prose + " changed end", "en", "b", 5),
        (2, None, "en", "b", None),
        (3, "", None, None, 0),
        (4, " \t\n ", "en", "b", 4),
        (None, prose, None, "c", 5),
        (None, None, None, None, None),
        (5, "three short words", "en", "c", 5),
        (6, LONG, "en", "a", 5),
        (7, "É中 ÉÉ x" * 3 + "\x0b\x0cend", "fr", "é", 5),
    ]
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    # Names that the operators use within.
    return df.selectExpr(*names, "'x' AS node", "'y' AS words", "1 AS row", "2 AS stats", "'z' AS text_hash", "3 AS n_words", "4 AS hash")


@pytest.fixture(scope="session")
def empty(awkward):
    return awkward.limit(0)
