"""Hybrid search: keyword and vector hits for the same queries, fused by rank."""

from pyspark.sql import DataFrame

from seekframe.operators.fuse import NUM_RESULTS, RRF_K, reciprocal_rank_fusion
from seekframe.operators.keyword import KeywordIndex, keyword_search
from seekframe.operators.vector import vector_search


def both_searches(
    index: KeywordIndex, vectors: DataFrame, queries: DataFrame, num_results: int = NUM_RESULTS
) -> list[DataFrame]:
    """Vector hits and keyword hits of ``queries(query_id, text, vec)``, in that order."""
    return [
        vector_search(vectors, queries, num_results, key=index.key),
        keyword_search(index, queries, num_results),
    ]


def hybrid_search(
    index: KeywordIndex,
    vectors: DataFrame,
    queries: DataFrame,
    num_results: int = NUM_RESULTS,
    k: int = RRF_K,
) -> DataFrame:
    """``(query_id, *key, score, rank)``: both searches fused by reciprocal rank."""
    lists = both_searches(index, vectors, queries, num_results)
    return reciprocal_rank_fusion(lists, index.key, k, num_results)
