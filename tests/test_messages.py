import json

import pytest
from pyspark.sql import functions as F

from seekframe.operators.rank import dense_number
from seekframe.plans import messages as msg

LOG = "conv_id long, turn long, role string, text string"
CALLS = "call_id string, name string, arguments string"


def test_history_goes_on_from_the_last_turn(spark):
    log = spark.createDataFrame([(1, 0, "user", "a"), (1, 4, "assistant", "b")], LOG)
    new = spark.createDataFrame(
        [(1, 30, "tool", "d"), (1, 7, "tool", "c"), (2, 5, "tool", "e")],
        "conv_id long, seq long, role string, text string",
    )
    rows = msg.append_history(log, new).orderBy("conv_id", "turn").collect()
    assert [(r.conv_id, r.turn, r.text) for r in rows] == [
        (1, 0, "a"),
        (1, 4, "b"),
        (1, 5, "c"),
        (1, 6, "d"),
        (2, 0, "e"),
    ]


@pytest.mark.parametrize("span", [1, 3, 10, 1000])
def test_numbering_of_a_hot_group_is_cut_into_runs(spark, span):
    """One group holds most rows; numbers must be dense whatever the run length."""
    rows = spark.range(100).select(
        F.when(F.col("id") < 70, 1).otherwise(F.col("id")).alias("g"),
        (F.col("id") * 3 - 50).alias("seq"),
    )
    start = spark.createDataFrame([(1, 10)], "g long, first long")
    numbered = dense_number(rows, "g", "seq", start, "n", span=span)
    got = {(r.g, r.seq): r.n for r in numbered.collect()}
    assert got == {
        (1, i * 3 - 50) if i < 70 else (i, i * 3 - 50): 10 + i if i < 70 else 0 for i in range(100)
    }


def test_bad_calls_are_rejected_with_a_reason(spark):
    calls = spark.createDataFrame(
        [
            ("ok", "search", '{"query": "x \\"y\\" {z}"}'),
            ("empty", "search", '{"query": ""}'),
            ("tool", "lookup", '{"query": "x"}'),
            ("noname", None, '{"query": "x"}'),
            ("broken", "search", '{"query": "x"'),
            ("text", "search", "x"),
            ("list", "search", '["query"]'),
            ("null", "search", None),
            ("missing", "search", '{"q": "x"}'),
            ("number", "search", '{"query": 5}'),
            ("nullquery", "search", '{"query": null}'),
            ("extra", "search", '{"query": "x", "n": 1}'),
        ],
        CALLS,
    )
    valid, rejects = msg.check_calls(calls)
    assert {r.call_id: r.query for r in valid.collect()} == {"ok": 'x "y" {z}', "empty": ""}
    assert {r.call_id: r.reason for r in rejects.collect()} == {
        "tool": "unknown tool",
        "noname": "unknown tool",
        "broken": "malformed arguments",
        "text": "malformed arguments",
        "list": "malformed arguments",
        "null": "malformed arguments",
        "missing": "missing query",
        "number": "query not a string",
        "nullquery": "query not a string",
        "extra": "unexpected argument",
    }


def test_dispatch_wraps_hits_in_rank_order_as_json(spark):
    docs = spark.createDataFrame([(1, "é", None), (2, "b", "t")], "doc_id long, a string, b string")
    calls = spark.createDataFrame([("c1", "x"), ("c2", "y")], "call_id string, query string")

    def search(asked):
        assert asked.columns == ["query_id", "text"]
        return spark.createDataFrame(
            [("c1", 1, 2), ("c1", 2, 1)], "query_id string, doc_id long, rank long"
        )

    rows = msg.dispatch_calls(calls, search, docs, ["a", "b"]).collect()
    outputs = {r.call_id: r for r in rows}
    assert all(r.type == "function_call_output" for r in rows)
    assert json.loads(outputs["c1"].output) == [{"a": "b", "b": "t"}, {"a": "é", "b": None}]
    assert outputs["c1"].output.count("\n") > 1
    assert json.loads(outputs["c2"].output) == []


def test_open_calls_status_answers_and_rounds(spark):
    log = spark.createDataFrame(
        [
            (1, 0, "user", "q"),
            (1, 1, "assistant", "calling"),
            (1, 2, "tool", "out"),
            (1, 3, "assistant", "answer"),
            (2, 0, "user", "q"),
            (2, 1, "assistant", "calling"),
            (3, 0, "user", "q"),
        ],
        LOG,
    )
    calls = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "conv_id long, turn long, call_id string")
    outputs = spark.createDataFrame([("a", "x", "[]")], "call_id string, type string, output string")
    assert [r.call_id for r in msg.open_calls(calls, outputs).collect()] == ["b"]
    status = {r.conv_id: r.finished for r in msg.conversation_status(log, calls).collect()}
    assert status == {1: True, 2: False}
    assert {r.conv_id: r.answer for r in msg.last_answer(log).collect()} == {1: "answer", 2: "calling"}
    assert {r.conv_id: r.rounds for r in msg.round_count(log).collect()} == {1: 2, 2: 1, 3: 0}


def test_pooling_keeps_the_best_score(spark):
    hits = spark.createDataFrame(
        [(1, 10, 5, 0.3), (1, 11, 5, 0.7), (1, 11, 6, 0.7), (1, 10, 7, 0.9), (2, 12, 5, 0.1)],
        "question_id long, query_id long, doc_id long, score double",
    )
    rows = msg.pool_hits(hits, 2).orderBy("question_id", "rank").collect()
    assert [(r.question_id, r.doc_id, r.score, r.found_by, r.rank) for r in rows] == [
        (1, 7, 0.9, 1, 1),
        (1, 5, 0.7, 2, 2),
        (2, 5, 0.1, 1, 1),
    ]
