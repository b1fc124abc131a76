import os

import pytest

os.environ.setdefault("OMP_NUM_THREADS", "1")

LONG = " ".join(f"word{i % 977}" for i in range(60_000))

AWKWARD = [
    (1, "one two three four five six seven eight nine ten " * 8, "en", "a", 1),
    (2, None, "en", "a", None),
    (3, "", None, "b", 0),
    (4, " \n\t \r\n", "en", None, 5),
    (5, "single", "en", "a", 6),
    (6, LONG, "en", "hot", len(LONG)),
    (7, LONG + " end", "en", "hot", len(LONG) + 4),
    (8, "single", "en", "a", 6),
    (8, "single", "en", "a", 6),
    (9, "Ünï ça \U0001f600 日本語 under the MIT License, Apache License, Version 2.0\x0bCC BY-NC", "x", "é", 9),
    (10, "a b c a b c a b c\nline\nline\n\nline", "en", "b", 3),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with nulls, empty and very long texts and repeated rows, and clashing columns."""
    docs = spark.createDataFrame(AWKWARD, SCHEMA)
    for name in ("key", "size", "score", "rank", "words", "kept", "fp", "tokens", "n_words"):
        docs = docs.selectExpr("*", f"'x' AS {name}")
    return docs


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
