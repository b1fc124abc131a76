"""Stored tables: documents with vectors, published in versions, and their exports."""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seekframe.functions.vectors import checked_width, vector_literal
from seekframe.session import path_exists


def with_vectors(docs: DataFrame, vectors: DataFrame, width: int, key: str = "doc_id") -> DataFrame:
    """Documents with their ``vec``, which arrive as two tables.

    Vectors computed from the documents need no join: add them as a column. Whoever
    computes the result fails on a document without vector, a vector without document,
    or a vector that is not ``width`` wide.
    """
    joined = (
        docs.withColumn("_doc", F.lit(True))
        .join(vectors.select(key, "vec").withColumn("_vec", F.lit(True)), key, "full_outer")
    )
    unpaired = F.col("_doc").isNull() | F.col("_vec").isNull()
    message = F.concat(F.lit(f"document and vector keys differ at {key} "), F.col(key).cast("string"))
    paired: Column = F.when(unpaired, F.raise_error(message)).otherwise(F.col(key))
    return joined.select(
        paired.alias(key),
        *[c for c in docs.columns if c != key],
        checked_width(F.col("vec"), width).alias("vec"),
    )


def publish(df: DataFrame, root: str) -> str:
    """Write ``df`` as the next version below ``root`` and return its path.

    Readers see the new version once its job has committed, and the old one until then.
    """
    version = max(_versions(df.sparkSession, root), default=0)
    while True:
        version += 1
        path = f"{root}/version={version:06d}"
        try:
            df.write.mode("errorifexists").parquet(path)
            return path
        except AnalysisException as error:
            # Another writer took the number: theirs stays, ours is the next one.
            if "PATH_ALREADY_EXISTS" not in str(error):
                raise


def open_current(spark: SparkSession, root: str) -> DataFrame:
    """The last committed version below ``root``."""
    committed = [v for v, done in _versions(spark, root).items() if done]
    if not committed:
        raise ValueError(f"nothing published below {root}")
    return spark.read.parquet(f"{root}/version={max(committed):06d}")


def export_literals(vectors: DataFrame, path: str, vec: str = "vec") -> None:
    """Write the table with its vectors as ``[x,y,...]`` text, for loading elsewhere."""
    vectors.withColumn(vec, vector_literal(F.col(vec))).write.mode("overwrite").json(path)


def _versions(spark: SparkSession, root: str) -> dict[int, bool]:
    """Version numbers below ``root``, and whether each has been committed."""
    if not path_exists(spark, root):
        return {}
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    listed = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    names = [status.getPath().getName() for status in listed]
    return {
        int(name.removeprefix("version=")): path_exists(spark, f"{root}/{name}/_SUCCESS")
        for name in names
        if name.startswith("version=")
    }
