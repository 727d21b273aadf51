import os

import pytest

TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog by the river", "en", "a"),
    (1, "The quick brown fox jumps over the lazy dog by the river", "en", "a"),
    (2, None, "en", "b"),
    (3, "", None, None),
    (4, " \n\t ", "de", "b"),
    (None, "ein kurzer Text über Äpfel", "de", None),
    (5, "word " * 3000, "en", "a"),
    (6, "x" * 5000, "fr", "c"),
    (7, "the quick brown fox jumps over the lazy dog by the river bank", "en", "a"),
    (8, "1234 5678", "es", "c"),
    (9, "mail jane.doe [at] example [dot] org or +1 (212) 555-0101", "en", "b"),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty, blank and long texts, repeated rows, and columns that clash with names used inside."""
    rows = [(i, t, lang, s, len(t or ""), f"x{n}", n) for n, (i, t, lang, s) in enumerate(TEXTS)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, n long"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def tables(spark, sf_dir):
    return lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")


@pytest.fixture(scope="session")
def larger(sf_dir):
    """Tables with enough held-out labels to measure accuracy on."""
    return "/root/testdata/sf0.01" if os.path.isdir("/root/testdata/sf0.01") else sf_dir
