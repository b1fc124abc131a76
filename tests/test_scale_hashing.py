"""Feature hashing counts a batch in blocks."""

from pyspark.sql import functions as F

from seekframe.functions import hashing


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def test_vectors_are_counted_in_blocks(spark, monkeypatch):
    rows = [(i, "one two three four " * (i % 5)) for i in range(60)] + [(60, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    whole = rows_of(docs.select("doc_id", hashing.hash_encode(F.col("text"), 8)))
    monkeypatch.setattr(hashing, "VALUES_AT_ONCE", 20)
    assert rows_of(docs.select("doc_id", hashing.hash_encode(F.col("text"), 8))) == whole
