"""Inputs that once gave wrong results, and limits that no longer exist."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from seekframe.operators import ann, vector
from seekframe.operators.ann import assign_cells, build_ivf_index, ivf_search, label_centres
from seekframe.operators.keyword import build_keyword_index, keyword_search, open_keyword_index
from seekframe.operators.rank import attach_payload, dense_number
from seekframe.operators.vector import vector_search
from seekframe.session import spread
from seekframe.sources.corpus import load_catalog, read_tree
from seekframe.sources.tables import open_current, publish


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, vec array<double>")


def test_vectors_of_mixed_width_are_an_error(spark):
    stored = vectors_of(spark, [(1, [1.0] * 3), (2, [1.0] * 5)]).coalesce(1)
    asked = spark.createDataFrame([(1, [1.0] * 4)], "query_id long, vec array<double>")
    with pytest.raises(Exception, match="differ in width"):
        vector_search(stored, asked).collect()


def test_ivf_with_all_cells_is_exact_under_dot(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=4)], i % 3) for i in range(30)]
    stored = spark.createDataFrame(rows, "doc_id long, vec array<double>, label int")
    index = build_ivf_index(stored, str(tmp_path / "ivf"), centres=label_centres(stored, "label"))
    asked = spark.createDataFrame([(1, [0.0] * 4), (2, [1.0] * 4)], "query_id long, vec array<double>")
    got = ivf_search(index, asked, 5, nprobe=3, metric="dot")
    exact = vector_search(stored, asked, 5, metric="dot")
    order = ["query_id", "rank"]
    assert got.orderBy(*order).collect() == exact.orderBy(*order).collect()
    assert got.where("query_id = 1").count() == 5


def test_cells_are_assigned_in_blocks_of_centres(spark, monkeypatch):
    rng = np.random.default_rng(2)
    stored = vectors_of(spark, [(i, [float(x) for x in rng.normal(size=3)]) for i in range(40)])
    centres = stored.select(F.col("doc_id").cast("int").alias("cell"), "vec").where("cell < 20")
    whole = assign_cells(stored, centres).select("doc_id", "cell").collect()
    monkeypatch.setattr(ann, "CENTRES_AT_ONCE", 3)
    assert assign_cells(stored, centres).select("doc_id", "cell").collect() == whole
    assert all(r.cell == r.doc_id for r in whole if r.doc_id < 20)


def test_many_filter_values_still_prune_the_scan(spark, monkeypatch):
    rows = [(i, [1.0, float(i)], i % 50) for i in range(100)]
    stored = spark.createDataFrame(rows, "doc_id long, vec array<double>, label int")
    asked = spark.createDataFrame(
        [(i, [1.0, 0.0], i) for i in range(20)], "query_id long, vec array<double>, label int"
    )
    wanted = sorted(map(tuple, vector_search(stored, asked, 5, on=("label",)).collect()))
    monkeypatch.setattr(vector, "LISTED_VALUES", 4)
    joined = vector_search(stored, asked, 5, on=("label",))
    assert "LeftSemi" in joined._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, joined.collect())) == wanted


def test_file_names_with_blanks_and_signs(spark, tmp_path, monkeypatch):
    root = tmp_path / "my docs" / "p"
    for name in ("x y.md", "sub dir/docs/p/z+1.md", "100%.md"):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text("text")
    names = {"x y.md", "sub dir/docs/p/z+1.md", "100%.md"}
    for place in (str(root), str(root) + "/", f"file://{root}"):
        assert {r.filename for r in read_tree(spark, place, {"md"}).collect()} == names


def test_a_null_fails_the_load_whatever_is_read(spark, tmp_path):
    (tmp_path / "n.json").write_text(json.dumps([{"a": "x", "b": None}]))
    docs = load_catalog(spark.createDataFrame([("n.json",)], "path string"), str(tmp_path), "a string, b string")
    for read in (docs.count, docs.select("a").collect):
        with pytest.raises(Exception, match="NULL in required field b"):
            read()


def test_catalogs_of_any_length(spark, tmp_path):
    names = [f"{i}.json" for i in range(7)]
    for i, name in enumerate(names):
        (tmp_path / name).write_text(json.dumps([{"a": i}]))
    catalog = spark.createDataFrame([(n,) for n in names], "path string")
    docs = load_catalog(catalog, str(tmp_path), "a int", paths_at_once=2)
    assert sorted(r.a for r in docs.collect()) == list(range(7))


def test_numbering_of_sparse_orders_and_nulls(spark):
    rows = [("a", i * 1_000_003) for i in range(100)] + [("b", 5), ("b", -7)]
    items = spark.createDataFrame(rows, "conv_id string, seq long")
    start = spark.createDataFrame([("a", 10)], "conv_id string, first long")
    got = dense_number(items, "conv_id", "seq", start, "n", span=8).collect()
    assert sorted((r.seq, r.n) for r in got if r.conv_id == "a") == [
        (i * 1_000_003, 10 + i) for i in range(100)
    ]
    assert sorted((r.seq, r.n) for r in got if r.conv_id == "b") == [(-7, 0), (5, 1)]
    for bad in [("a", None), (None, 1)]:
        broken = spark.createDataFrame([("a", 1), bad], "conv_id string, seq long")
        with pytest.raises(Exception, match="NULL in required field"):
            dense_number(broken, "conv_id", "seq", start, "n").collect()


def test_a_repeated_key_fails_the_index_build(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b"), (1, "c d")], "doc_id long, text string")
    with pytest.raises(ValueError, match="occurs 2 times"):
        build_keyword_index(docs, str(tmp_path / "i"), ["text"])


def test_a_build_that_dies_leaves_the_old_index(spark, tmp_path):
    path = str(tmp_path / "i")
    asked = spark.createDataFrame([(1, "old")], "query_id long, text string")
    old = spark.createDataFrame([(1, "old words")], "doc_id long, text string")
    build_keyword_index(old, path, ["text"])
    broken = spark.createDataFrame([(1, "new"), (2, None)], "doc_id long, text string")
    with pytest.raises(Exception, match="NULL in required field"):
        build_keyword_index(broken, path, ["text"])
    assert keyword_search(open_keyword_index(spark, path), asked).first().doc_id == 1


def test_two_writers_of_one_version(spark, tmp_path, monkeypatch):
    from seekframe.sources import tables

    root = str(tmp_path / "t")
    publish(spark.createDataFrame([(1,)], "a int"), root)
    monkeypatch.setattr(tables, "_versions", lambda *_: {})  # as seen before the other wrote
    assert publish(spark.createDataFrame([(2,)], "a int"), root).endswith("version=000002")
    monkeypatch.undo()
    assert open_current(spark, root).first().a == 2


def test_small_inputs_are_spread_without_a_job(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "t"))
    small = spread(spark.read.parquet(str(tmp_path / "t")), "id")
    assert "RepartitionByExpression" in small._jdf.queryExecution().analyzed().toString()
    large = spread(spark.range(10**12), "id")
    assert "Repartition" not in large._jdf.queryExecution().analyzed().toString()


def test_payload(spark):
    hits = spark.createDataFrame([(1, 7, 0.5, 1), (1, 8, 0.4, 2)], "query_id int, doc_id int, score double, rank int")
    docs = spark.createDataFrame([(7, "a", "x"), (8, "b", "y"), (9, "c", "z")], "doc_id int, t string, u string")
    rows = attach_payload(hits, docs, ["t"]).orderBy("rank").collect()
    assert [(r.doc_id, r.t, r.rank) for r in rows] == [(7, "a", 1), (8, "b", 2)]
    with pytest.raises(ValueError, match="payload named like"):
        attach_payload(hits, docs.withColumnRenamed("t", "score"), ["score"])


def test_lists_are_pruned_by_term_and_meet_once(spark, tmp_path, monkeypatch):
    from seekframe.operators import keyword

    texts = ["red fox", "red hen", "blue fox", "grey owl red", "fox fox red", "hen", ""] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    asked = spark.createDataFrame([(1, "red fox"), (2, "owl"), (3, "nothing")], "query_id long, text string")
    whole = build_keyword_index(docs, str(tmp_path / "one"), ["text"])
    wanted = keyword_search(whole, asked, 5).orderBy("query_id", "rank").collect()
    assert {r.query_id for r in wanted} == {1, 2}
    monkeypatch.setattr(keyword, "DOCS_PER_SHARD", 4)
    monkeypatch.setattr(keyword, "MATCHES_AT_ONCE", 3)
    index = build_keyword_index(docs, str(tmp_path / "many"), ["text"])
    assert index.lists.select("shard").distinct().count() > 1
    hits = keyword_search(index, asked, 5)
    assert hits.orderBy("query_id", "rank").collect() == wanted
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "In(term, [" in plan
    assert plan.count("Exchange hashpartitioning") == 2  # lists to their shard, hits to their query
    monkeypatch.setattr(keyword, "LISTED_TERMS", 1)
    assert keyword_search(index, asked, 5).orderBy("query_id", "rank").collect() == wanted
