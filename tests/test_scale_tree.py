"""The file tree: how its files are written and read."""

import gzip

import pytest
from pyspark.sql import DataFrameReader
from pyspark.sql import functions as F

from registered import inputs
from seekframe.session import local_folder
from seekframe.sources.corpus import LISTING, read_tree

PAGES = [("page 1", "a\nb"), ("page 1", "c"), ("page 2", None), ("page -3", ""), (None, "x")]


def landed(spark, root):
    pages = spark.createDataFrame(PAGES, "name string, value string")
    inputs.land_files(pages, root)
    rows = read_tree(spark, root, {"txt"}, F.col("filename").startswith("name=page ")).collect()
    return {r.filename.split("/")[0]: sorted(r.content.split("\n")) for r in rows}, len(rows)


def test_both_writers_land_the_same_pages(spark, tmp_path, monkeypatch):
    own = landed(spark, str(tmp_path / "own files"))
    made = [p.name for p in (tmp_path / "own files").rglob("*") if p.parent.name.startswith("name=")]
    assert made == ["part.txt"] * 3  # no checksum, nothing unfinished, one file a page
    monkeypatch.setattr(inputs, "local_folder", lambda *_: None)
    assert own == landed(spark, str(tmp_path / "spark"))
    assert own[0]["name=page 1"] == ["", "a", "b", "c"] and own[1] == 3


def test_only_mounted_folders_are_written_as_files(spark, tmp_path):
    assert local_folder(spark, f"{tmp_path}/a b") == f"{tmp_path}/a b"
    assert local_folder(spark, f"file://{tmp_path}/x") == f"{tmp_path}/x"
    viewed = {"fs.viewfs.mounttable.tree.link./t": f"file://{tmp_path}"}
    for name, value in viewed.items():
        spark._jsc.hadoopConfiguration().set(name, value)
    assert local_folder(spark, "viewfs://tree/t/x") is None


@pytest.mark.parametrize("extensions", [{"txt"}, {"txt", "md"}])
def test_files_are_read_as_bytes_like_whole_texts(spark, tmp_path, extensions, monkeypatch):
    for name, content in {
        "a/1 +%.txt": "é\n\n".encode(),
        "b/c/2.md": b"no line end",
        "b/empty.txt": b"",
        "b/bad.txt": b"\xff\xfe ok\r\n",
        "b/bom.txt": b"\xef\xbb\xbfx",
    }.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(content)
    used, before = [], spark.conf.get(LISTING)
    text = DataFrameReader.text
    monkeypatch.setattr(DataFrameReader, "text", lambda self, *a, **b: used.append(a) or text(self, *a, **b))
    rows = read_tree(spark, str(tmp_path), extensions).select("filename", F.col("content").cast("binary"))
    got = {r.filename.rsplit("/", 1)[-1]: bytes(r[1]) for r in rows.collect()}
    assert not used and spark.conf.get(LISTING) == before
    glob = "*.{" + ",".join(sorted(extensions)) + "}"
    whole = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    whole = whole.text(str(tmp_path), wholetext=True).select(F.col("value").cast("binary").alias("v"))
    assert sorted(got.values()) == sorted(bytes(r.v) for r in whole.collect())
    assert got["1 +%.txt"] == "é\n\n".encode()


def test_packed_files_are_still_unpacked(spark, tmp_path):
    (tmp_path / "x.txt.gz").write_bytes(gzip.compress(b"text\n"))
    assert [r.content for r in read_tree(spark, str(tmp_path), {"gz"}).collect()] == ["text\n"]


def test_small_files_share_tasks(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    names = [(f"page {i}", "x") for i in range(6 * cores)]
    inputs.land_files(spark.createDataFrame(names, "name string, value string"), str(tmp_path / "t"))
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")  # a split for each file
    try:
        docs = read_tree(spark, str(tmp_path / "t"), {"txt"})
        assert docs.rdd.getNumPartitions() == 4 * cores and docs.count() == len(names)
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
