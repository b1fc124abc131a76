"""Keyword index: what moves, how large a shard is, what a filter leaves to be scored."""

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from seekframe.operators import keyword


@pytest.fixture
def texts(spark):
    rows = [(i, "ab"[i % 2], f"red w{i} w{i // 3} fox" * (i % 4)) for i in range(40)]
    return spark.createDataFrame(rows, "doc_id long, course string, text string")


def asked(spark):
    return spark.createDataFrame([(1, "red fox w3"), (2, "w1 w9"), (1, "w5")], "query_id long, text string")


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def test_shards_are_bounded_by_postings(spark, texts, tmp_path, monkeypatch):
    whole = keyword.build_keyword_index(texts, str(tmp_path / "a"), ["text"], ["course"])
    monkeypatch.setattr(keyword, "POSTINGS_PER_SHARD", 5)
    monkeypatch.setattr(keyword, "TOKENS_AT_ONCE", 4)
    cut = keyword.build_keyword_index(
        texts, str(tmp_path / "b"), ["text"], ["course"], broadcast_terms=3
    )
    sizes = cut.lists.where("term <> ''").groupBy("shard").agg(F.sum(F.size("docs")).alias("n"))
    assert sizes.count() > whole.lists.select("shard").distinct().count()

    def weights(index):
        return [(*r[:-1], round(r[-1], 12)) for r in rows_of(keyword.postings(index, 3))]

    assert weights(cut) == weights(whole)
    for kept in (None, {"course": "a"}):
        hits = [rows_of(keyword.keyword_search(i, asked(spark), 5, filters=kept)) for i in (whole, cut)]
        assert hits[0] == hits[1] and hits[0]


def test_inverting_moves_no_documents(spark, texts):
    words = texts.select("doc_id", "course", F.split("text", " ").alias("text"))
    lists = keyword._inverted(words, ["text"], ("doc_id",), ["course"])
    assert "Exchange" not in lists._jdf.queryExecution().executedPlan().toString()


def test_filtered_documents_are_not_scored(spark, texts, tmp_path, monkeypatch):
    index = keyword.build_keyword_index(texts.coalesce(1), str(tmp_path / "x"), ["text"], ["course"])
    lists = index.lists.toArrow()
    lists = lists.filter(pc.equal(lists["shard"], lists["shard"][0]))
    lists = lists.set_column(2, "term", lists["term"].cast(pa.string()))
    weights = keyword._query_weights(index, asked(spark), {}, ()).toArrow()

    class Shared:
        value = keyword._query_matrix(weights, ("text",), ())

    scored, real = [], keyword._scores
    monkeypatch.setattr(keyword, "_scores", lambda ls, e, n: scored.append(len(ls[0])) or real(ls, e, n))
    for kept in ({}, {"course": "a"}, {"course": "none"}):
        keyword._best_of_shard(Shared, ("doc_id",), ("text",), kept, (), 5)(lists)
    assert 0 == scored[2] < scored[1] < scored[0]
