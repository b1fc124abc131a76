import json

import pytest
from pyspark.sql import functions as F

from seekframe.sources.corpus import filter_paths, first_match, load_catalog, read_tree
from seekframe.sources.tables import export_literals, open_current, publish, with_vectors

SCHEMA = "course string, section string, question string, answer string"


def entry(**changes):
    return {"course": "c", "section": "s", "question": "q", "answer": "a"} | changes


@pytest.fixture
def landed(spark, tmp_path):
    (tmp_path / "json").mkdir()
    two = [entry(), entry(question="line\nbreak")]
    (tmp_path / "json/one.json").write_text(json.dumps(two, indent=1))
    (tmp_path / "json/two.json").write_text(json.dumps([entry(course="d")]))
    (tmp_path / "json/null.json").write_text(json.dumps([entry(answer=None)]))
    (tmp_path / "json/broken.json").write_text('[{"course": "c", ')

    def load(*paths, prefix=str(tmp_path)):
        catalog = spark.createDataFrame([(p,) for p in paths], "path string")
        return load_catalog(catalog, prefix, SCHEMA)

    return load


def test_catalog_lists_the_files_to_read(landed, tmp_path):
    rows = landed("json/one.json", "json/two.json").collect()
    assert sorted(r.question for r in rows) == ["line\nbreak", "q", "q"]
    for prefix, path in [(f"{tmp_path}/", "/json/two.json"), (str(tmp_path), "/json/two.json")]:
        assert [r.course for r in landed(path, prefix=prefix).collect()] == ["d"]


def test_bad_catalog_files_fail_the_load(landed):
    with pytest.raises(Exception, match="NULL in required field answer"):
        landed("json/two.json", "json/null.json").collect()
    with pytest.raises(Exception):
        landed("json/broken.json").collect()
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        landed("json/two.json", "json/none.json").collect()


def test_tree_reader_filters_by_extension_and_path(spark, tmp_path):
    for name, text in {
        "a/lessons/1.md": "first {line}\nsecond",
        "b/2.md": "no",
        "a/lessons/3.txt": "no",
    }.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
    kept = F.col("filename").contains("/lessons/")
    rows = read_tree(spark, str(tmp_path), {"md"}, kept).collect()
    assert [tuple(r) for r in rows] == [("a/lessons/1.md", "first {line}\nsecond")]
    assert read_tree(spark, str(tmp_path), {"md", "txt"}).count() == 3


def test_path_filter_and_first_match(spark):
    docs = spark.createDataFrame(
        [(2, "x/lessons/b.md"), (1, "x/lessons/a.md"), (3, "x/lessons/c.txt"), (4, "y/d.md")],
        "doc_id long, filename string",
    )
    rows = filter_paths(docs, "filename", "/lessons/", {"md"}).collect()
    assert {r.doc_id for r in rows} == {1, 2}
    assert first_match(docs, "filename", "lessons").first().doc_id == 1
    with pytest.raises(Exception, match="no filename contains none"):
        first_match(docs, "filename", "none").collect()


def docs_and_vectors(spark, keys, vector_keys, width=2):
    docs = spark.createDataFrame([(k, f"t{k}") for k in keys], "doc_id long, text string")
    vectors = spark.createDataFrame(
        [(k, [float(k)] * width) for k in vector_keys], "doc_id long, vec array<float>"
    )
    return docs, vectors


def test_versions_switch_when_committed(spark, tmp_path):
    root = str(tmp_path / "t")
    with pytest.raises(ValueError):
        open_current(spark, root)
    for keys in ([1, 2], [3]):
        publish(with_vectors(*docs_and_vectors(spark, keys, keys), 2), root)
        assert {r.doc_id: list(r.vec) for r in open_current(spark, root).collect()} == {
            k: [k, k] for k in keys
        }
    with pytest.raises(Exception):
        publish(with_vectors(*docs_and_vectors(spark, [1], [2]), 2), root)
    assert [r.doc_id for r in open_current(spark, root).collect()] == [3]
    publish(with_vectors(*docs_and_vectors(spark, [9], [9]), 2), root)
    assert [r.doc_id for r in open_current(spark, root).collect()] == [9]


@pytest.mark.parametrize(
    "keys, vector_keys, width, message",
    [([1, 2], [1], 2, "keys differ"), ([1], [1, 2], 2, "keys differ"), ([1], [1], 3, "not 2 wide")],
)
def test_unpaired_or_misshapen_vectors_fail(spark, keys, vector_keys, width, message):
    with pytest.raises(Exception, match=message):
        with_vectors(*docs_and_vectors(spark, keys, vector_keys, width), 2).collect()


def test_literal_export(spark, tmp_path):
    _, vectors = docs_and_vectors(spark, [], [1])
    export_literals(vectors, str(tmp_path / "x"))
    row = spark.read.json(str(tmp_path / "x")).first()
    assert (row.doc_id, row.vec) == (1, "[1.000000,1.000000]")
