"""Loading corpora: files named by a catalog, file trees, and lookups by path."""

import math
import uuid
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seekframe.functions.text import all_present, required
from seekframe.session import shared_dir

PATHS_AT_ONCE = 50_000  # the reader plans its splits from such a list on the driver
LISTING_TASKS = 32  # per core; Spark's own bound of 10,000 is mostly start-up
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
PACKED = {"bz2", "deflate", "gz", "lz4", "snappy", "zst", "zstd"}  # files that Hadoop unpacks


def join_path(prefix: str, path: Column) -> Column:
    """Prefix and path with exactly one slash between them."""
    return F.concat(F.lit(prefix.rstrip("/") + "/"), F.ltrim(path, F.lit("/")))


def load_catalog(
    catalog: DataFrame,
    prefix: str,
    schema: str,
    multi_line: bool = True,
    paths_at_once: int = PATHS_AT_ONCE,
) -> DataFrame:
    """Rows of all JSON files that ``catalog(path)`` lists below ``prefix``.

    Files hold one array each (``multi_line``) or one object per line. A file that is
    missing, malformed JSON and a NULL in any field of ``schema`` all fail the job, whichever
    columns are read. Up to ``paths_at_once`` paths are one scan; a longer catalog goes
    through the driver in lists of that length, each appended to a table in the shared folder.
    """
    spark = catalog.sparkSession
    listed = catalog.select(join_path(prefix, required("path")).alias("path")).distinct()
    rows = (row.path for row in listed.toLocalIterator())

    def scan(paths: list[str]) -> DataFrame:
        docs = spark.read.schema(schema).json(paths, multiLine=multi_line, mode="FAILFAST")
        return docs.where(all_present(*docs.columns))

    paths, more = list(islice(rows, paths_at_once)), list(islice(rows, paths_at_once))
    if not more:
        return scan(paths)
    landed = f"{shared_dir(spark)}/catalog-{uuid.uuid4().hex}"
    scan(paths).write.parquet(landed)
    while more:
        scan(more).write.mode("append").parquet(landed)
        more = list(islice(rows, paths_at_once))
    return spark.read.parquet(landed)


def read_tree(
    spark: SparkSession, root: str, extensions: set[str], path_filter: Column | None = None
) -> DataFrame:
    """``(filename, content)`` of every file below ``root`` with one of ``extensions``.

    ``filename`` is relative to ``root``; ``path_filter`` is a predicate on it. Point
    ``root`` at a snapshot folder to pin a version.

    Files are read as bytes, since the reader of whole texts copies the configuration of
    Hadoop for every file, unless they may be packed, which only that reader undoes. Small
    files share a task up to the size of a split, instead of so many for their number.
    """
    packed = {e.rsplit(".", 1)[-1] for e in extensions} & PACKED
    reader = spark.read.option("recursiveFileLookup", True).option(
        "pathGlobFilter", "*.{" + ",".join(sorted(extensions)) + "}"
    )
    listing, most = spark.conf.get(LISTING), LISTING_TASKS * spark.sparkContext.defaultParallelism
    spark.conf.set(LISTING, str(min(int(listing), most)))
    try:
        files = reader.text(root, wholetext=True) if packed else reader.format("binaryFile").load(root)
    finally:
        spark.conf.set(LISTING, listing)
    content = F.col("value") if packed else F.col("content").cast("string")
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    below = system.makeQualified(folder).toUri().getPath().rstrip("/") + "/"
    # The path is a URI: percent-encoded, where a plus sign stands for itself.
    uri = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    path = F.regexp_replace(uri, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    docs = files.select(
        F.substr(path, F.lit(len(below) + 1)).alias("filename"),
        content.alias("content"),
    )
    size = int(files._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    docs = docs.coalesce(max(4 * spark.sparkContext.defaultParallelism, math.ceil(size / split)))
    return docs if path_filter is None else docs.where(path_filter)


def filter_paths(
    docs: DataFrame, path: str, contains: str, extensions: set[str] | None = None
) -> DataFrame:
    """Rows whose path contains a string and ends in one of ``extensions``."""
    kept = docs.where(F.col(path).contains(contains))
    if extensions is None:
        return kept
    return kept.where(F.substring_index(F.col(path), ".", -1).isin(sorted(extensions)))


def first_match(docs: DataFrame, column: str, contains: str, key: str = "doc_id") -> DataFrame:
    """The row of smallest ``key`` whose ``column`` contains a string; an error if none."""
    found = docs.where(F.col(column).contains(contains))
    best = found.agg(F.min_by(F.struct(*docs.columns), key).alias("row"))
    row = F.coalesce("row", F.raise_error(F.lit(f"no {column} contains {contains}")))
    return best.select(row.alias("row")).select("row.*")
