import pytest

from seekframe.plans import prompt

DOCS = [
    (1, "General", "Can I join {late}?", "Yes."),
    (2, "Tools", "Which shell?", "Any.\n"),
    (3, "Tools", "Why?", "  "),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, section string, question string, answer string")


@pytest.fixture(scope="module")
def asked(spark):
    return spark.createDataFrame([(1, "join {x}"), (2, "none")], "query_id long, text string")


@pytest.fixture(scope="module")
def hits(spark):
    return spark.createDataFrame([(1, 2, 2), (1, 1, 1)], "query_id long, doc_id long, rank long")


CONTEXT = "General\nQ: Can I join {late}?\nA: Yes.\n\nTools\nQ: Which shell?\nA: Any."


def test_context_follows_the_rank_and_keeps_queries_without_hits(docs, asked, hits):
    rows = prompt.build_context(asked, hits, docs, prompt.faq_block()).collect()
    assert {r.query_id: r.context for r in rows} == {1: CONTEXT, 2: ""}


def test_prompt_text(docs, asked, hits):
    rows = prompt.retrieve_prompts(asked, hits, docs, prompt.faq_block()).collect()
    assert {r.query_id: r.prompt for r in rows} == {
        1: "QUESTION: \n    join {x}\n\nCONTEXT:\n    " + CONTEXT,
        2: "QUESTION: \n    none\n\nCONTEXT:\n    ",
    }


def test_other_template(docs, asked, hits):
    rows = prompt.retrieve_prompts(
        asked, hits, docs, prompt.faq_block(), template="{{{context}}} {question}?"
    ).collect()
    assert {r.prompt for r in rows} == {"{" + CONTEXT + "} join {x}?", "{} none?"}
    with pytest.raises(KeyError):
        prompt.retrieve_prompts(asked, hits, docs, prompt.faq_block(), template="{other}")


def test_chunk_block(spark, asked):
    docs = spark.createDataFrame([(1, "a.md", "text")], "doc_id long, filename string, content string")
    hits = spark.createDataFrame([(1, 1, 1)], "query_id long, doc_id long, rank long")
    rows = prompt.build_context(asked, hits, docs, prompt.chunk_block()).collect()
    assert {r.query_id: r.context for r in rows}[1] == "Filename: a.md\nContent: text"


def test_null_field_fails(spark, asked, hits):
    docs = spark.createDataFrame(
        [(1, "s", "q", None)], "doc_id long, section string, question string, answer string"
    )
    with pytest.raises(Exception, match="NULL in required field answer"):
        prompt.build_context(asked, hits, docs, prompt.faq_block()).collect()


def test_messages(spark):
    prompts = spark.createDataFrame([(1, "p")], "query_id long, prompt string")
    rows = prompt.build_messages(prompts, "be brief").orderBy("turn").collect()
    assert [(r.turn, r.role, r.content) for r in rows] == [
        (0, "developer", "be brief"),
        (1, "user", "p"),
    ]


def test_usage(spark):
    log = spark.createDataFrame(
        [(1, "user", "a b"), (1, "assistant", "c, c c"), (2, "tool", "d")],
        "conv_id long, role string, text string",
    )
    prices = spark.createDataFrame([("user", 1.0), ("assistant", 10.0)], "role string, price double")
    rows = prompt.usage_totals(log, prices).collect()
    assert {(r.conv_id, r.tokens, r.cost) for r in rows} == {(1, 5, 32.0), (2, 1, 0.0)}


def test_documents_are_not_shuffled(docs, asked, hits, spark, tmp_path):
    docs.write.parquet(str(tmp_path / "d"))
    stored = spark.read.parquet(str(tmp_path / "d"))
    context = prompt.build_context(asked, hits, stored, prompt.faq_block())
    plan = context._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [doc_id" in plan and "hashpartitioning(doc_id" not in plan
