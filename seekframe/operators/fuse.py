"""Reciprocal rank fusion of ranked hit lists."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seekframe.operators.rank import top_k
from seekframe.session import union_all

# Fixed values of the fusion rule: its constant, and the default result length.
RRF_K = 60
NUM_RESULTS = 5


def label_lists(lists: list[DataFrame]) -> DataFrame:
    """Stack hit lists into one long table, ``list_no`` telling them apart."""
    return union_all([hits.withColumn("list_no", F.lit(i)) for i, hits in enumerate(lists)])


def reciprocal_rank_fusion(
    lists: list[DataFrame],
    key: tuple[str, ...],
    k: int = RRF_K,
    num_results: int = NUM_RESULTS,
    payload: tuple[str, ...] = (),
) -> DataFrame:
    """Fuse lists of ``(query_id, *key, rank, *payload)`` into one ranked list per query.

    A key earns ``1 / (k + position)`` for every time it is listed, positions
    counting from 0 (``rank`` counts from 1). Equal sums keep the order of first
    appearance: earlier list first, then better rank. The payload is that of the
    last appearance. The list is cut to ``num_results`` after the fusion.
    """
    place = F.struct("list_no", "rank")
    columns = ["query_id", *key, "rank", *payload]
    fused = (
        label_lists([hits.select(*columns) for hits in lists])
        .groupBy("query_id", *key)
        .agg(
            # Sums of doubles have no fixed order in Spark, so ties are made exact by rounding.
            F.round(F.sum(1 / (F.lit(k) + F.col("rank") - 1)), 12).alias("score"),
            F.min(place).alias("_first"),
            *[F.max_by(c, place).alias(c) for c in payload],
        )
    )
    return top_k(fused, num_results, [F.desc("score"), F.asc("_first")]).drop("_first")


def list_report(lists: DataFrame, name: str) -> DataFrame:
    """Names found per query and list, sorted, duplicates kept; takes ``label_lists`` output."""
    return lists.groupBy("query_id", "list_no").agg(
        F.array_join(F.sort_array(F.collect_list(name)), ",").alias("names")
    )


def ranked_names(hits: DataFrame, name: str) -> DataFrame:
    """Names of a single (fused) list per query, best first."""
    listed = F.array_sort(F.collect_list(F.struct("rank", F.col(name).alias("name"))))
    return hits.groupBy("query_id").agg(
        F.array_join(F.transform(listed, lambda h: h["name"].cast("string")), ",").alias("names")
    )
