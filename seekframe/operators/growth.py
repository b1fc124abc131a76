"""A vector index that grows: segments, deletes, compaction, and exact search within bounds.

The index is a log of steps below ``path/log``, each published as a version. A step adds a
segment of vectors, deletes keys, or both; a key deleted or added anew by step s is gone from
all segments before s. A writer that finds its number taken gets the next one, so no step of
another writer is lost. Readers see the steps that have been committed. ``compact`` writes the
live rows of all steps up to the first uncommitted number as a new base; later steps stay.

Vectors lie by the cell of their nearest centre; the centres are those of the first build. A
segment has its own statistics: rows per cell and the least cosine of a row to the centre of its
cell. That is a radius, and by the triangle inequality of angles no row of a cell is nearer
to a query than the angle to the centre less the radius. ``bounded_search`` leaves out only
cells that this rules out, so its hits are those of the exact search.
"""

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from seekframe.functions.vectors import cosine_distance
from seekframe.operators.ann import IvfIndex, assign_cells, kmeans_centres, probe_cells
from seekframe.operators.rank import top_k
from seekframe.operators.vector import vector_search
from seekframe.session import shared_dir, union_all
from seekframe.sources.tables import _versions, publish

SLACK = 1e-6  # scores are rounded to 6 places
PROBES_PER_VECTOR = 64

_LOG = "kind string, folder string, upto int, adds boolean, schema string"


@dataclass(frozen=True)
class GrownIndex(IvfIndex):
    stats: DataFrame  # cell, rows, least_cosine; deleted rows may still count
    key: tuple[str, ...]


def create_index(
    vectors: DataFrame,
    path: str,
    key: tuple[str, ...] = ("doc_id",),
    cells: int | None = None,
    centres: DataFrame | None = None,
    seed: int = 42,
) -> GrownIndex:
    """A new index of ``vectors`` (*key, further columns, vec); keys must be unique."""
    spark = vectors.sparkSession
    if _versions(spark, f"{path}/log"):
        raise ValueError(f"there is an index at {path}")
    if centres is None:
        cells = cells or max(1, round(vectors.count() ** 0.5))
        centres = kmeans_centres(vectors, cells, seed)
    centres.coalesce(1).write.parquet(f"{path}/centres")
    folder = f"{path}/base-{uuid.uuid4().hex}"
    schema = _write_segment(vectors, spark.read.parquet(f"{path}/centres"), folder, key)
    _publish(spark, path, "base", folder, 0, True, schema)
    return open_index(spark, path, key)


def grow(
    index_path: str,
    added: DataFrame | None = None,
    deleted: DataFrame | None = None,
    key: tuple[str, ...] = ("doc_id",),
) -> None:
    """One step: remove the keys of ``deleted``, then add the rows of ``added``.

    An added row replaces the row of its key. Keys of ``deleted`` that the index lacks, and
    a key that is deleted twice, change nothing.
    """
    given = [df for df in (added, deleted) if df is not None]
    if not given:
        raise ValueError("nothing to add or delete")
    spark = given[0].sparkSession
    folder = f"{index_path}/step-{uuid.uuid4().hex}"
    gone = union_all([df.select(*key) for df in given]).distinct()
    gone.write.parquet(f"{folder}/deletes")
    schema = ""
    if added is not None:
        centres = spark.read.parquet(f"{index_path}/centres")
        schema = _write_segment(added, centres, folder, key)
    _publish(spark, index_path, "step", folder, 0, added is not None, schema)


def open_index(
    spark: SparkSession, path: str, key: tuple[str, ...] = ("doc_id",)
) -> GrownIndex:
    """The live rows of all committed steps, with the statistics of their segments."""
    _, base, steps = _state(spark, path)
    return _opened(spark, path, base, steps, key)


def compact(spark: SparkSession, path: str, key: tuple[str, ...] = ("doc_id",)) -> None:
    """Write the live rows as one segment; steps committed meanwhile stay on top of it."""
    versions, base, steps = _state(spark, path)
    upto = 0
    while versions.get(upto + 1):
        upto += 1
    live = _opened(spark, path, base, [s for s in steps if s["version"] <= upto], key)
    folder = f"{path}/base-{uuid.uuid4().hex}"
    schema = _write_segment(live.vectors.drop("cell"), live.centres, folder, key)
    _publish(spark, path, "base", folder, upto, True, schema)


def bounded_search(
    index: GrownIndex, queries: DataFrame, num_results: int = 5, first: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(hits, probes): the exact nearest by cosine, and the (query_id, cell) looked into.

    The ``first`` nearest cells (the square root of all, unless given) give each query a score
    to beat; then it looks into every other cell that may hold as good a row.
    """
    first = first or max(1, round(index.cells**0.5))
    asked = queries.select("query_id", "vec")
    ranked = _written(probe_cells(index.centres, asked, index.cells), "probes")
    key = index.key

    n_asked = asked.count()

    def within(probes: DataFrame) -> DataFrame:
        # In a slice of queries, this many probes take about the room of one vector.
        rows = n_asked + probes.count() // PROBES_PER_VECTOR
        return vector_search(
            index.vectors, asked, num_results, key=key, on=("cell",), query_rows=rows, probes=probes
        )

    near = ranked.where(F.col("rank") <= first).select("query_id", "cell")
    hits = _written(within(near), "near-hits")
    bar = hits.where(F.col("rank") == num_results).select("query_id", F.col("score").alias("bar"))
    angle = F.acos(F.least(F.col("score") + SLACK, F.lit(1.0)))
    radius = F.acos(F.greatest(F.least(F.col("least_cosine") - 1e-9, F.lit(1.0)), F.lit(-1.0)))
    bound = F.cos(F.greatest(angle - radius, F.lit(0.0)))
    more = _written(
        ranked.where(F.col("rank") > first)
        .join(index.stats.where("least_cosine is not null"), "cell")
        .join(bar, "query_id", "left")
        .where(F.col("bar").isNull() | (bound + SLACK >= F.col("bar")))
        .select("query_id", "cell"),
        "more-probes",
    )
    every = hits.drop("rank").unionByName(within(more).drop("rank"))
    best = top_k(every, num_results, [F.desc("score"), *map(F.asc, key)])
    return best, near.unionByName(more)


def _write_segment(
    vectors: DataFrame, centres: DataFrame, folder: str, key: tuple[str, ...]
) -> str:
    """Vectors by cell and statistics per cell below ``folder``; the schema as JSON."""
    spark = vectors.sparkSession
    celled = assign_cells(vectors, centres)
    celled.hint("rebalance", F.col("cell")).write.partitionBy("cell").parquet(f"{folder}/vectors")
    written = spark.read.schema(celled.schema).parquet(f"{folder}/vectors")
    twice = written.groupBy(*key).count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"key occurs twice: {twice[0].asDict()}")
    cosine = 1 - cosine_distance(F.col("vec"), F.col("centre"))
    stats = (
        written.join(centres.select("cell", F.col("vec").alias("centre")), "cell")
        .groupBy("cell")
        .agg(F.count(F.lit(1)).alias("rows"), F.min(cosine).alias("least_cosine"))
    )
    stats.coalesce(1).write.parquet(f"{folder}/stats")
    return celled.schema.json()


def _publish(spark, path: str, kind: str, folder: str, upto: int, adds: bool, schema: str) -> None:
    publish(spark.createDataFrame([(kind, folder, upto, adds, schema)], _LOG).coalesce(1), f"{path}/log")


def _state(spark: SparkSession, path: str) -> tuple[dict[int, bool], dict, list[dict]]:
    """Versions of the log, the last base, and the committed steps that it does not hold."""
    versions = _versions(spark, f"{path}/log")
    folders = [f"{path}/log/version={v:06d}" for v, done in versions.items() if done]
    if not folders:
        raise ValueError(f"no index at {path}")
    # One row per step since the first build; no data of the index.
    log = spark.read.option("basePath", f"{path}/log").schema(f"{_LOG}, version int")
    rows = sorted((r.asDict() for r in log.parquet(*folders).collect()), key=lambda r: r["version"])
    base = [r for r in rows if r["kind"] == "base"][-1]
    # The first build is the base of all steps, whatever their numbers.
    return versions, base, [r for r in rows if r["kind"] == "step" and r["version"] > base["upto"]]


def _opened(spark, path: str, base: dict, steps: list[dict], key: tuple[str, ...]) -> GrownIndex:
    segments = [(base["upto"], base)] + [(s["version"], s) for s in steps if s["adds"]]

    def rows(segment: dict) -> DataFrame:
        kept = StructType.fromJson(json.loads(segment["schema"]))
        return spark.read.schema(kept).parquet(f"{segment['folder']}/vectors")

    vectors = rows(base)
    if steps:
        placed = union_all([rows(s).withColumn("_segment", F.lit(number)) for number, s in segments])
        gone = union_all(
            [
                spark.read.parquet(f"{s['folder']}/deletes").withColumn("_step", F.lit(s["version"]))
                for s in steps
            ]
        )
        # The last step that removes a key removes it from all segments before.
        last = gone.groupBy(*key).agg(F.max("_step").alias("_step"))
        renamed = last.select(*[F.col(k).alias(f"_gone_{k}") for k in key], "_step")
        same = [F.col(k) == F.col(f"_gone_{k}") for k in key]
        removed = [*same, F.col("_step") > F.col("_segment")]
        vectors = placed.join(renamed, removed, "left_anti").drop("_segment")
    stats = union_all([spark.read.parquet(f"{s['folder']}/stats") for _, s in segments])
    centres = spark.read.parquet(f"{path}/centres")
    return GrownIndex(
        vectors=vectors,
        centres=centres,
        cells=centres.count(),
        stats=stats.groupBy("cell").agg(
            F.sum("rows").alias("rows"), F.min("least_cosine").alias("least_cosine")
        ),
        key=key,
    )


def _written(df: DataFrame, name: str) -> DataFrame:
    path = f"{shared_dir(df.sparkSession)}/search/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
