"""Searches of many queries: what moves for each slice, and what for the answers."""

import pytest
from pyspark.sql import functions as F

from seekframe.operators import keyword
from seekframe.plans import messages as msg


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    words = [f"red w{i} w{i // 3} fox" * (i % 4) for i in range(60)]
    rows = [(i, "ab"[i % 2], f"t{i % 7}", text) for i, text in enumerate(words)]
    docs = spark.createDataFrame(rows, "doc_id long, course string, title string, text string")
    path = str(tmp_path_factory.mktemp("index") / "x")
    most, keyword.DOCS_PER_SHARD = keyword.DOCS_PER_SHARD, 7
    try:
        return keyword.build_keyword_index(docs, path, ["title", "text"], ["course"])
    finally:
        keyword.DOCS_PER_SHARD = most


def asked(spark):
    rows = [(f"q{i % 25}", f"red fox w{i} w{i // 2} t{i % 9} t3", "abc"[i % 3]) for i in range(30)]
    return spark.createDataFrame(rows, "query_id string, text string, course string")


def rows_of(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("kept", [None, {"course": "a"}, {"course": "none"}])
@pytest.mark.parametrize("match", [(), ("course",)])
def test_slices_share_lists_that_move_once(spark, index, monkeypatch, kept, match):
    whole = keyword.keyword_search(index, asked(spark), 3, {"text": 2.0}, kept, match)
    # Each query in a block of its own, all terms rows of the matrix or none.
    for cells, share in ((1, 1 / 256), (10_000, 0.3), (10_000, 2.0)):
        monkeypatch.setattr(keyword, "CELLS_AT_ONCE", cells)
        monkeypatch.setattr(keyword, "DENSE_SHARE", share)
        cut = keyword.keyword_search(index, asked(spark), 3, {"text": 2.0}, kept, match, 60)
        assert "FlatMapGroupsInArrow" not in cut._jdf.queryExecution().executedPlan().toString()
        assert rows_of(cut) == rows_of(whole)
    assert (cut.count() > 0) == (kept != {"course": "none"})


def test_what_a_filter_leaves_is_packed(index):
    shards = index.lists.select("shard").distinct().count()
    packed = keyword._packed(index, {"course": "a"}).count()
    assert shards > 4 and packed == 1


def test_best_cells_are_those_of_a_full_sort():
    import numpy as np

    cells = np.random.default_rng(5).integers(0, 60, (20, 1000)) / 50.0 - 0.3
    row, place, value = keyword._best_cells(cells, 4, width=16)
    for i in range(20):
        first = np.lexsort((np.arange(1000), -np.round(cells[i], 6)))[:4]
        assert place[row == i].tolist() == first.tolist()
        assert value[row == i].tolist() == np.round(cells[i][first], 6).tolist()


def test_records_without_a_hit_do_not_move(spark):
    docs = spark.range(100).select(F.col("id").alias("doc_id"), F.lit("x").alias("a"))
    calls = spark.createDataFrame([("c1", "x"), ("c1", "y"), (None, "z")], "call_id string, query string")
    hits = spark.createDataFrame(
        [("c1", 1, 2), ("c1", 2, 1), (None, 3, 1)], "query_id string, doc_id long, rank long"
    )
    runs = []

    def search(queries):
        runs.append(queries)
        return hits

    answers = msg.dispatch_calls(calls, search, docs, ["doc_id"], pretty=False)
    assert "LeftSemi" in answers._jdf.queryExecution().optimizedPlan().toString()
    best = '[{"doc_id":2},{"doc_id":1}]'
    assert [r.output for r in answers.orderBy("call_id").collect()] == ["[]", best, best]
    assert len(runs) == 1
