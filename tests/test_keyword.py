import math
import re
from collections import Counter

import pytest

from seekframe.operators.keyword import (
    build_keyword_index,
    keyword_search,
    open_keyword_index,
    postings,
)

DOCS = [
    (1, "a", "red apple", "an apple that is red"),
    (2, "a", "green apple", "an apple that is green, green!"),
    (3, "b", "red car", "a car"),
    (4, "b", "", "..."),
    (5, "a", "red apple", "an apple that is red"),
    (6, "b", "plum", "the the the the plum"),
]
FIELDS = ["title", "body"]


def words(text):
    return [t for t in re.split(r"[\W_]+", text.lower()) if t]


def brute_force(queries, k, boosts=None, course=None):
    """The scoring rule, document by document."""
    boosts = boosts or {}
    tf = {(d[0], f): Counter(words(d[2 + i])) for d in DOCS for i, f in enumerate(FIELDS)}
    df = {f: Counter(t for d in DOCS for t in tf[d[0], f]) for f in FIELDS}

    def unit(counts, field):
        known = {t: n for t, n in counts.items() if t in df[field]}
        w = {t: n * (math.log((1 + len(DOCS)) / (1 + df[field][t])) + 1) for t, n in known.items()}
        length = math.sqrt(sum(x * x for x in w.values()))
        return {t: x / length for t, x in w.items()}

    hits = set()
    for query_id, text in queries:
        ranked = []
        for doc_id, doc_course, *_ in DOCS:
            if course and doc_course != course:
                continue
            score = 0.0
            for f in FIELDS:
                q, d = unit(Counter(words(text)), f), unit(tf[doc_id, f], f)
                score += boosts.get(f, 1.0) * sum(q[t] * d.get(t, 0.0) for t in q)
            if round(score, 6) > 0:
                ranked.append((-round(score, 6), doc_id))
        for rank, (score, doc_id) in enumerate(sorted(ranked)[:k], 1):
            hits.add((query_id, doc_id, -score, rank))
    return hits


QUERIES = [(1, "red apple"), (2, "green"), (3, ""), (4, "unknown words"), (5, "the plum that is a car")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, course string, title string, body string")


@pytest.fixture(scope="module")
def index(docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index") / "x")
    return build_keyword_index(docs, path, FIELDS, ["course"])


def asked(spark):
    return spark.createDataFrame(QUERIES, "query_id long, text string")


def as_set(hits):
    return {(r.query_id, r.doc_id, r.score, r.rank) for r in hits.collect()}


@pytest.mark.parametrize("k", [1, 2, 5])
@pytest.mark.parametrize("boosts", [None, {"title": 3.0}, {"title": 0.5, "body": 2.0}])
def test_scores_and_ties(spark, index, k, boosts):
    got = as_set(keyword_search(index, asked(spark), k, boosts))
    assert got == brute_force(QUERIES, k, boosts)
    if k == 1:
        assert (1, 1) in {(q, d) for q, d, _, _ in got}  # copies tie, the smaller key wins


def test_filter_keeps_statistics_of_the_whole_index(spark, index):
    got = as_set(keyword_search(index, asked(spark), 5, filters={"course": "b"}))
    assert got == brute_force(QUERIES, 5, course="b")


def test_filter_by_the_query_s_own_value(spark, index):
    queries = spark.createDataFrame(
        [(q, t, "a" if q == 1 else "b") for q, t in QUERIES],
        "query_id long, text string, course string",
    )
    got = as_set(keyword_search(index, queries, 5, match=("course",)))
    assert got == brute_force(QUERIES[:1], 5, course="a") | brute_force(QUERIES[1:], 5, course="b")


def test_slices_batches_and_reopening_change_nothing(spark, docs, tmp_path):
    build_keyword_index(docs, str(tmp_path / "x"), FIELDS, ["course"])
    again = open_keyword_index(spark, str(tmp_path / "x"))
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    try:
        got = as_set(keyword_search(again, asked(spark), slice_terms=5))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    assert got == brute_force(QUERIES, 5)


def test_common_terms_are_split_from_rare_ones(spark, index, docs, tmp_path):
    split = build_keyword_index(docs, str(tmp_path / "x"), FIELDS, ["course"], broadcast_terms=4)

    def weights(rows):
        return {(r.doc_id, r.field, r.term): round(r.weight, 12) for r in rows.collect()}

    assert weights(postings(split, 4)) == weights(postings(index))
    assert as_set(keyword_search(split, asked(spark))) == brute_force(QUERIES, 5)


def test_compound_and_string_keys(spark, tmp_path):
    docs = spark.createDataFrame(
        [("f1", 0, "one two"), ("f1", 1000, "two three"), ("f0", 0, "two")],
        "filename string, start long, content string",
    )
    index = build_keyword_index(docs, str(tmp_path / "x"), ["content"], key=("filename", "start"))
    queries = spark.createDataFrame([(1, "two")], "query_id long, text string")
    hits = keyword_search(index, queries).orderBy("rank").collect()
    assert [(h.filename, h.start) for h in hits] == [("f0", 0), ("f1", 0), ("f1", 1000)]


def test_unknown_boost_and_filter_are_errors(spark, index):
    with pytest.raises(ValueError, match="unknown text field"):
        keyword_search(index, asked(spark), boosts={"context": 3.0})
    with pytest.raises(ValueError, match="not a keyword"):
        keyword_search(index, asked(spark), filters={"title": "x"})


def test_null_text_fails_the_build(spark, tmp_path):
    docs = spark.createDataFrame([(1, None)], "doc_id long, body string")
    with pytest.raises(Exception, match="NULL in required field body"):
        build_keyword_index(docs, str(tmp_path / "x"), ["body"])


def test_empty_corpus_and_empty_queries(spark, index, tmp_path):
    none = spark.createDataFrame([], "doc_id long, body string")
    empty = build_keyword_index(none, str(tmp_path / "x"), ["body"])
    assert keyword_search(empty, asked(spark)).count() == 0
    assert keyword_search(index, asked(spark).limit(0)).count() == 0


def test_plan_moves_only_asked_lists_and_the_top_k(spark, index):
    """The lists that are asked for meet in their shard, the best hits at their query."""
    hits = keyword_search(index, asked(spark), filters={"course": "a"})
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2
    assert "In(term, [" in plan
    assert "WindowGroupLimit" in plan.split("Exchange")[1]
    assert {r.course for r in hits.join(index.documents, "doc_id").select("course").collect()} == {"a"}
