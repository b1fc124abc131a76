"""Helpers that several operators of this subpackage share."""

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seekframe.session import shared_dir

#: White space as the contracts count it: space and the control characters 9 to 13.
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def spaced(text: Column) -> Column:
    """The text with every white-space character turned into a space, trimmed."""
    return F.trim(F.translate(text, SPACES, " " * len(SPACES)))


def words_of(text: Column) -> Column:
    """The words of a text: maximal runs of characters that are not white space."""
    even = spaced(text)
    return F.when(even == "", F.array().cast("array<string>")).otherwise(F.split(even, " +"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared folder and read back: lineage ends in files."""
    path = f"{shared_dir(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def prefix_sums(
    df: DataFrame, group: list[str], order: list[str], weight: Column, name: str, rows: int
) -> DataFrame:
    """``df`` with the sum of ``weight`` over the rows before each row of its group as ``name``.

    The order inside a group is by a hash bucket of ``order`` first, so that a group that
    holds most rows is summed in many tasks; the buckets' totals are summed after that.
    ``rows`` is the row count of ``df``; a bucket holds about 10,000 rows of the largest
    group at most. ``df`` is read twice and should be a stored table.
    """
    buckets = max(256, rows // 10_000)
    cut = df.withColumn("_weight", weight.cast("bigint")).withColumn(
        "_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int")
    )
    inside = Window.partitionBy(*group, "_bucket").orderBy(*order)
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        cut.groupBy(*group, "_bucket")
        .agg(F.sum("_weight").alias("_total"))
        .withColumn("_start", F.coalesce(F.sum("_total").over(before), F.lit(0)))
        .drop("_total")
    )
    summed = cut.withColumn(
        "_sum",
        F.sum("_weight").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_weight"),
    )
    return (
        summed.join(starts, [*group, "_bucket"])
        .withColumn(name, (F.col("_start") + F.col("_sum")).cast("bigint"))
        .drop("_bucket", "_weight", "_sum", "_start")
    )
