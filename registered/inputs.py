"""Input tables under the field names of the library, and tables derived once from them.

Indexes are built once per application and input folder, then reopened by every query
that searches them. They are written below the shared folder of the session.
"""

import hashlib
import os
import uuid
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seekframe.functions.hashing import hash_encode
from seekframe.functions.text import compose
from seekframe.operators.ann import (
    IvfIndex,
    build_ivf_index,
    label_centres,
    open_ivf_index,
)
from seekframe.operators.chunk import chunk_documents
from seekframe.operators.growth import GrownIndex, compact, create_index, grow, open_index
from seekframe.operators.keyword import KeywordIndex, build_keyword_index, open_keyword_index
from seekframe.session import local_folder, path_exists, remove_path, shared_dir, spread

FAQ_TEXT_FIELDS = ["question", "section", "answer"]

_built: set[str] = set()  # paths whose build this process has seen through


def forget() -> None:
    """Have every derived table built anew at its next use."""
    _built.clear()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def faq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as FAQ entries."""
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.col("source").alias("course"),
        F.col("lang").alias("section"),
        F.substring_index("text", "\n", 1).alias("question"),
        F.col("text").alias("answer"),
    )


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items as queries."""
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def encoded_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions(spark, sf_dir).withColumn("vec", hash_encode(F.col("text")))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").alias("vec"), "label"
    )


def vector_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded benchmark items as queries, each with a label to filter by."""
    label = (F.col("query_id") % 10).cast("int")
    return encoded_questions(spark, sf_dir).select("query_id", "vec", label.alias("label"))


def faq_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored FAQ entries with the vectors of question and answer."""
    path, ready = _place(spark, sf_dir, "faq_vectors")
    if not ready:
        body = compose("question", "answer")
        entries = spread(faq(spark, sf_dir), "doc_id").withColumn("vec", hash_encode(body))
        entries.write.mode("overwrite").parquet(path)
        _built.add(path)
    return spark.read.parquet(path)


def faq_index(spark: SparkSession, sf_dir: str) -> KeywordIndex:
    path, ready = _place(spark, sf_dir, "faq_index")
    if ready:
        return open_keyword_index(spark, path)
    index = build_keyword_index(faq(spark, sf_dir), path, FAQ_TEXT_FIELDS, ["course"])
    _built.add(path)
    return index


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored chunks of all documents with their vectors."""
    path, ready = _place(spark, sf_dir, "chunks")
    if not ready:
        docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
        cut = chunk_documents(spread(docs, "doc_id"))
        cut.withColumn("vec", hash_encode(F.col("content"))).write.mode("overwrite").parquet(path)
        _built.add(path)
    return spark.read.parquet(path)


def chunk_index(spark: SparkSession, sf_dir: str) -> KeywordIndex:
    path, ready = _place(spark, sf_dir, "chunk_index")
    if ready:
        return open_keyword_index(spark, path)
    index = build_keyword_index(
        chunks(spark, sf_dir), path, ["content"], ["source"], key=("doc_id", "start")
    )
    _built.add(path)
    return index


def label_ivf(spark: SparkSession, sf_dir: str) -> IvfIndex:
    path, ready = _place(spark, sf_dir, "label_ivf")
    if ready:
        return open_ivf_index(spark, path)
    stored = vectors(spark, sf_dir)
    index = build_ivf_index(stored, path, centres=label_centres(stored, "label"))
    _built.add(path)
    return index


def kmeans_ivf(spark: SparkSession, sf_dir: str) -> IvfIndex:
    path, ready = _place(spark, sf_dir, "kmeans_ivf")
    if ready:
        return open_ivf_index(spark, path)
    index = build_ivf_index(vectors(spark, sf_dir), path)
    _built.add(path)
    return index


def stored_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hundredth stored vector as a query."""
    held = vectors(spark, sf_dir).where("vec_id % 100 = 0")
    return held.select(F.col("vec_id").alias("query_id"), "vec")


def grown_index(spark: SparkSession, sf_dir: str, compacted: bool = False) -> GrownIndex:
    """The even ids, then the odd ones added and every tenth id from 3 deleted."""
    path, ready = _place(spark, sf_dir, f"grown-{compacted}")
    if not ready:
        if path_exists(spark, path):
            remove_path(spark, path)
        stored = vectors(spark, sf_dir)
        create_index(stored.where("vec_id % 2 = 0"), path, ("vec_id",))
        grow(path, added=stored.where("vec_id % 2 = 1"), key=("vec_id",))
        grow(path, deleted=stored.where("vec_id % 10 = 3"), key=("vec_id",))
        if compacted:
            compact(spark, path, ("vec_id",))
        _built.add(path)
    return open_index(spark, path, ("vec_id",))


def new_folder(spark: SparkSession, sf_dir: str, name: str) -> str:
    """A place for a table written anew by every run of a query."""
    path, _ = _place(spark, sf_dir, f"{name}-{uuid.uuid4().hex}")
    return path


def land_files(pages: DataFrame, root: str) -> None:
    """Write the ``value`` of every ``name`` as a line of ``root/name=<name>/part.txt``.

    All cores write, a page being a folder and a file whatever its size. Hadoop starts a
    process for each file on a local disk to set its permissions, so there the tasks write
    the files themselves, each moved to its place when whole; their list is the output of the
    job. Elsewhere Spark's writer makes the same tree, and each task commits its own.
    """
    spark = pages.sparkSession
    dealt = pages.repartition(4 * spark.sparkContext.defaultParallelism, "name")
    folder = local_folder(spark, root)
    if folder is None:
        commit = "mapreduce.fileoutputcommitter.algorithm.version"
        dealt.write.option(commit, "2").partitionBy("name").text(root)
        return
    named = dealt.where(F.col("name").isNotNull()).sortWithinPartitions("name")
    named.mapInArrow(_lines_to_files(folder), "path string").write.text(f"{root}/_landed")


def _lines_to_files(folder: str):
    """Function for ``mapInArrow``: write rows that are sorted by name, return the paths."""

    def land(batches):
        last, out, done = None, None, []

        def close():
            if out is not None:
                out.close()
                os.replace(out.name, done[-1])

        for batch in batches:
            for name, value in zip(batch["name"].to_pylist(), batch["value"]):
                if name != last:
                    close()
                    at = f"{folder}/name={quote(name, safe=' ')}"
                    os.makedirs(at, exist_ok=True)
                    out, last = open(f"{at}/.part-{uuid.uuid4().hex}", "wb"), name
                    done.append(f"{at}/part.txt")
                out.write(value.as_buffer() or b"")
                out.write(b"\n")
            if len(done) > 1:
                yield pa.RecordBatch.from_pydict({"path": done[:-1]})
                done = done[-1:]
        close()
        yield pa.RecordBatch.from_pydict({"path": pa.array(done, pa.string())})

    return land


def _place(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, bool]:
    digest = hashlib.md5(sf_dir.encode()).hexdigest()[:8]
    path = f"{shared_dir(spark)}/{digest}/{name}"
    return path, path in _built and path_exists(spark, path)
