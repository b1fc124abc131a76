"""Session helpers: the shared folder, slices of query tables and spreading of small inputs."""

import math
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder for tables that later jobs read back, unique to the application.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may run
    without that setting; it gets a temporary folder.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        if sc.applicationId not in _local_dirs:
            _local_dirs[sc.applicationId] = tempfile.mkdtemp(prefix="run-")
            if not sc._jsc.sc().getCheckpointDir().isDefined():
                sc.setCheckpointDir(_local_dirs[sc.applicationId])
        root = _local_dirs[sc.applicationId]
    return f"{root.rstrip('/')}/seekframe-{sc.applicationId}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, on whatever file system its path names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library has written."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def local_folder(spark: SparkSession, path: str) -> str | None:
    """The path as plain files have it, if it is on a file system that every machine mounts."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    uri = system.makeQualified(target).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def slices(df: DataFrame, key: str, size: float, limit: float) -> list[DataFrame]:
    """Cut ``df`` by a hash of ``key`` so that each part is about ``limit`` in size.

    ``size`` is the measured size of ``df`` in whatever unit ``limit`` has. This is
    how query tables stay broadcastable: when one is too large for a single
    broadcast, the corpus is scanned once per slice and still never shuffled.
    """
    n = max(1, math.ceil(size / limit))
    if n == 1:
        return [df]
    part = F.pmod(F.xxhash64(key), F.lit(n))
    return [df.where(part == i) for i in range(n)]


def union_all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def spread(df: DataFrame, *key: str) -> DataFrame:
    """Repartition a small input, so that heavy work per row is not left to a few tasks.

    A small file may be a single row group, which one task reads however many splits it
    has. Small is what Spark would not cut into a split per core, by the planner's estimate
    of the size; a larger input is left as it is, so texts are shuffled only where that is
    cheap. No job is run to find out.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    split = spark._jsparkSession.sessionState().conf().filesOpenCostInBytes()
    return df.repartition(cores, *key) if size < cores * split else df
