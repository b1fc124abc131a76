import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from seekframe.operators.chunk import chunk_documents


def cut(spark, texts, size, step):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {}
    for row in chunk_documents(docs, "text", size, step).collect():
        out.setdefault(row.doc_id, []).append((row.start, row.content))
    return [sorted(out[i]) for i in range(len(texts))]


def expected(text, size, step):
    last = step * max(0, -(-(len(text) - size) // step))
    return [(at, text[at : at + size]) for at in range(0, last + 1, step)]


@pytest.mark.parametrize("size, step", [(4, 2), (4, 4), (5, 3), (4, 1), (6, 4)])
def test_windows(spark, size, step):
    texts = ["", "a", "abcd", "abcde", "abcdef", "abcdefg", "abcdefghijklm", "é😀\n" * 7]
    assert cut(spark, texts, size, step) == [expected(t, size, step) for t in texts]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    texts=st.lists(st.text(st.characters(exclude_categories=["Cs"])), min_size=1, max_size=20),
    step=st.integers(1, 9),
    more=st.integers(0, 9),
)
def test_chunks_rebuild_the_text(spark, texts, step, more):
    size = step + more
    for text, chunks in zip(texts, cut(spark, texts, size, step)):
        rebuilt = "".join(content[:step] for _, content in chunks[:-1]) + chunks[-1][1]
        assert rebuilt == text
        assert chunks == expected(text, size, step)


def test_other_columns_are_kept_and_null_fails(spark):
    docs = spark.createDataFrame([(1, "x", "abc")], "doc_id long, lang string, text string")
    assert chunk_documents(docs).columns == ["doc_id", "lang", "start", "content"]
    docs = spark.createDataFrame([(1, None)], "doc_id long, text string")
    with pytest.raises(Exception, match="NULL in text column"):
        chunk_documents(docs).collect()


@pytest.mark.parametrize("size, step", [(1, 2), (2, 0), (2, -1)])
def test_bad_window(spark, size, step):
    with pytest.raises(ValueError):
        cut(spark, ["abc"], size, step)


def test_sizes_without_a_common_divisor(spark):
    text = "".join(chr(97 + i % 26) for i in range(1000)) + "\U0001f600é"
    docs = spark.createDataFrame([(1, text), (2, ""), (3, "short")], "doc_id int, text string")
    for size, step in [(200, 99), (101, 100), (7, 3), (50, 50)]:
        got = {(r.doc_id, r.start): r.content for r in chunk_documents(docs, "text", size, step).collect()}
        wanted = {}
        for key, whole in [(1, text), (2, ""), (3, "short")]:
            last = max(0, -(-(len(whole) - size) // step))
            wanted |= {(key, i * step): whole[i * step : i * step + size] for i in range(last + 1)}
        assert got == wanted
