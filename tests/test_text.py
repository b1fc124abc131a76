import pytest
from pyspark.sql import functions as F

from seekframe.functions.text import compose, strip, tokens


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "text, expected",
    [
        ("", []),
        (" .,; ", []),
        ("One, two-TWO 3x!", ["one", "two", "two", "3x"]),
        ("Été à l'école", ["été", "à", "l", "école"]),
        ("a_b\nc", ["a", "b", "c"]),
    ],
)
def test_tokens(spark, text, expected):
    assert one(spark, tokens(F.lit(text))) == expected


def test_strip_removes_line_breaks_at_both_ends_only(spark):
    assert one(spark, strip(F.lit("\n\t a\n b \r\n"))) == "a\n b"


def test_compose_joins_and_rejects_null(spark):
    rows = spark.createDataFrame([("q", "a")], "question string, answer string")
    assert rows.select(compose("question", "answer")).first()[0] == "q\na"
    rows = spark.createDataFrame([("q", None)], "question string, answer string")
    with pytest.raises(Exception, match="NULL in required field answer"):
        rows.select(compose("question", "answer")).collect()
