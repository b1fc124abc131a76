"""Connected components of a table of links, by alternating stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seekframe.llm.common import stored


def _both_ways(edges: DataFrame) -> DataFrame:
    turned = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return edges.select("a", "b").unionByName(turned)


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's least neighbour."""
    around = _both_ways(edges)
    least = around.groupBy("a").agg(F.min("b").alias("m"))
    tied = around.where("b > a").join(least, "a")
    return tied.select(F.col("b").alias("a"), F.least("m", "a").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    tied = down.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.unionByName(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(a, b)``; the root is the least node connected.

    Rounds of a large and a small star shrink every component to a star in a number of
    rounds that grows with the logarithm of its size. Each round is written to the shared
    folder. A hub is one row per link, which skewed joins can split; no group is collected.
    """
    current = stored(edges.where("a != b").select("a", "b").distinct(), "links")
    before = None
    while True:
        state = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        before = state
        if state[0] == 0:
            break
        current = stored(_small_star(_large_star(current)).distinct(), "links")
    ends = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root"))
    return ends.unionByName(roots).distinct()
