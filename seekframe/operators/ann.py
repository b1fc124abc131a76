"""Approximate vector search over inverted lists (IVF).

Vectors are stored by the cell of their nearest centre. A query looks into its
``nprobe`` nearest cells only, which the scan turns into partition pruning.
"""

import math
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seekframe.functions.vectors import norm
from seekframe.operators.vector import _matrix, vector_search
from seekframe.sources.tables import open_current, publish

CENTRES_AT_ONCE = 4_096  # columns of a score block, to bound its memory


@dataclass(frozen=True)
class IvfIndex:
    vectors: DataFrame  # *key, further columns, vec, cell (partition column)
    centres: DataFrame  # cell, vec
    cells: int


def kmeans_centres(
    vectors: DataFrame, cells: int, seed: int = 42, max_iter: int = 20
) -> DataFrame:
    """``(cell, vec)`` from k-means under cosine distance over all rows."""
    spark = vectors.sparkSession
    points = vectors.where(norm(F.col("vec")) > 0).select(
        array_to_vector(F.col("vec")).alias("features")
    )
    model = KMeans(k=cells, seed=seed, maxIter=max_iter, distanceMeasure="cosine").fit(points)
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return spark.createDataFrame(rows, "cell int, vec array<double>")


def label_centres(vectors: DataFrame, label: str) -> DataFrame:
    """``(cell, vec)``: the mean vector of every label, for data that is grouped already."""
    return (
        vectors.select(F.col(label).alias("cell"), F.posexplode("vec").alias("_dim", "_v"))
        .groupBy("cell", "_dim")
        .agg(F.avg(F.col("_v").cast("double")).alias("_v"))
        .groupBy("cell")
        .agg(F.array_sort(F.collect_list(F.struct("_dim", "_v"))).alias("_vs"))
        .select("cell", F.transform("_vs", lambda x: x["_v"]).alias("vec"))
    )


def assign_cells(vectors: DataFrame, centres: DataFrame) -> DataFrame:
    """Add ``cell``, the centre of greatest cosine (smallest cell on ties); no shuffle."""
    table = centres.orderBy("cell").toArrow()
    shared = vectors.sparkSession.sparkContext.broadcast(
        (table["cell"].to_numpy(), _matrix(table["vec"], "cosine"))
    )

    def nearest(vec):
        cells, centre_matrix = shared.value
        if len(vec) == 0:
            return pa.array([], type=pa.int32())
        x = _matrix(pa.chunked_array([vec]), "cosine")
        best, place = np.full(len(x), -np.inf), np.zeros(len(x), np.int64)
        for at in range(0, len(centre_matrix), CENTRES_AT_ONCE):
            scores = np.round(x @ centre_matrix[at : at + CENTRES_AT_ONCE].T, 9)
            # A zero vector has no direction: NaN is never better, so it stays in the first cell.
            top = np.argmax(np.nan_to_num(scores, nan=-2.0), axis=1)
            score = scores[np.arange(len(x)), top]
            better = score > best
            best[better], place[better] = score[better], at + top[better]
        return pa.array(cells[place], type=pa.int32())

    cell = F.arrow_udf(nearest, "int").asNondeterministic()("vec")
    return vectors.where(F.col("vec").isNotNull()).withColumn("cell", cell)


def build_ivf_index(
    vectors: DataFrame,
    path: str,
    cells: int | None = None,
    seed: int = 42,
    centres: DataFrame | None = None,
) -> IvfIndex:
    """Write ``vectors`` by cell below ``path``; centres are trained unless given.

    A build goes to a folder of its own, which readers see when all of it is written.
    """
    spark = vectors.sparkSession
    if centres is None:
        if cells is None:
            cells = max(1, round(math.sqrt(vectors.count())))
        centres = kmeans_centres(vectors, cells, seed)
    build = f"{path}/build-{uuid.uuid4().hex}"
    centres.coalesce(1).write.parquet(f"{build}/centres")
    stored = spark.read.parquet(f"{build}/centres")
    # Rebalancing splits a cell that holds much of the table and merges small ones.
    (
        assign_cells(vectors, stored)
        .hint("rebalance", F.col("cell"))
        .write.partitionBy("cell")
        .parquet(f"{build}/vectors")
    )
    publish(spark.createDataFrame([(build,)], "build string"), f"{path}/current")
    return open_ivf_index(spark, path)


def open_ivf_index(spark: SparkSession, path: str) -> IvfIndex:
    build = open_current(spark, f"{path}/current").first().build
    centres = spark.read.parquet(f"{build}/centres")
    return IvfIndex(
        vectors=spark.read.parquet(f"{build}/vectors"), centres=centres, cells=centres.count()
    )


def ivf_search(
    index: IvfIndex,
    queries: DataFrame,
    num_results: int = 5,
    nprobe: int | None = None,
    key: tuple[str, ...] = ("doc_id",),
    on: tuple[str, ...] = (),
    metric: str = "cosine",
) -> DataFrame:
    """``vector_search`` within the ``nprobe`` cells nearest to each query.

    ``nprobe`` defaults to the square root of the number of cells, rounded up; with all
    cells probed the result is that of the exact search.
    """
    nprobe = nprobe or math.ceil(math.sqrt(index.cells))
    probes = probe_cells(index.centres, queries, nprobe, metric)
    return vector_search(
        index.vectors,
        queries,
        num_results,
        key=key,
        on=("cell", *on),
        metric=metric,
        query_rows=queries.count() * nprobe,
        probes=probes.select("query_id", "cell"),
    )


def nprobe_for(
    index: IvfIndex,
    queries: DataFrame,
    exact: DataFrame,
    recall: float,
    key: tuple[str, ...] = ("doc_id",),
    metric: str = "cosine",
) -> int:
    """The fewest cells to probe so that ``recall`` of the exact hits of ``queries`` are found.

    An exact hit is found once the cell it lies in is probed. ``queries`` is a sample: all cells
    are ranked for each.
    """
    cells = probe_cells(index.centres, queries, index.cells, metric)
    needed = (
        exact.select("query_id", *key)
        .join(index.vectors.select(*key, "cell"), list(key))
        .join(cells.select("query_id", "cell", F.col("rank").alias("needed")), ["query_id", "cell"])
    )
    hits = {r["needed"]: r["count"] for r in needed.groupBy("needed").count().collect()}
    total, found = sum(hits.values()), 0
    for nprobe in sorted(hits):
        found += hits[nprobe]
        if found >= recall * total:
            return nprobe
    return index.cells


def probe_cells(
    centres: DataFrame, queries: DataFrame, nprobe: int, metric: str = "cosine"
) -> DataFrame:
    """``(query_id, cell, score, rank)``: the cells each query looks into."""
    asked = queries.select("query_id", "vec")
    return vector_search(centres, asked, nprobe, key=("cell",), metric=metric)
