"""Mixing of sources to target weights by blocks of a fixed number of words.

The words of a source, its documents laid end to end, form blocks of ``block`` words. The
mix draws as many blocks of a source as its target asks for. Which output shard takes how
many of them is a multinomial draw per source, so the counts of a shard are multinomial in
the sources, given the totals. The slots of a source count through the shards; slot j takes
the block that a pseudorandom permutation of the source's blocks gives for j, and starts the
next pass through all blocks when one is done. Blocks are joined by (source, block).

Targets: all sources together get ``share`` times all words, in proportion to their weights.
A source's target stops at ``most`` times its words; the excess goes to the other sources by
weight, until none is above. No block is drawn more than ``most`` times, so no document is
taken more often.

Defined results: a null or empty text has size 0 and is never taken; a null source is a
source of its own, last in order. Repeated rows are documents of their own. Rows of one
source with the same id and size are interchangeable. The same input gives the same mix,
however it is partitioned. There is one row per source in the table of targets, which is
worked on in one task: it grows with the names of sources, not with documents.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seekframe.llm.common import prefix_sums, stored, text_of, words_of

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2
BLOCK = 128
SHARD_BLOCKS = 4096
SEED = 11

_MASK = np.uint64(0xFFFFFFFF)


def source_targets(
    sizes: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
) -> DataFrame:
    """(source, number, source_size, target) from ``sizes(source, source_size)``.

    Resharing until none is above its limit has a closed form: with the sources in order of
    limit per weight, the first ones are at their limits and the others share the rest.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    numbered = sizes.withColumn("number", F.row_number().over(by_name) - 1)
    cycle = F.array(*[F.lit(w) for w in weights])
    limited = numbered.withColumn("weight", F.get(cycle, F.col("number") % len(weights))).withColumn(
        "limit", F.lit(float(most)) * F.col("source_size")
    )
    everything = Window.partitionBy()
    filled = Window.orderBy(F.col("limit") / F.col("weight"), "number")
    upto = filled.rowsBetween(Window.unboundedPreceding, -1)
    level = (
        F.lit(share) * F.sum("source_size").over(everything)
        - F.coalesce(F.sum("limit").over(upto), F.lit(0.0))
    ) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(upto), F.lit(0.0))
    )
    # The level of the first source that stays below its limit holds for all after it.
    below = (
        limited.withColumn("level", level)
        .withColumn("open", F.col("level") * F.col("weight") < F.col("limit"))
        .withColumn("ratio", F.col("limit") / F.col("weight"))
        .withColumn(
            "final",
            F.min(F.when(F.col("open"), F.struct("ratio", "number", "level"))).over(everything)[
                "level"
            ],
        )
    )
    target = F.when(F.col("final").isNull(), F.col("limit")).otherwise(
        F.least(F.col("limit"), F.col("final") * F.col("weight"))
    )
    return below.select("source", "number", "source_size", target.alias("target"))


def permuted(index: np.ndarray, size: np.ndarray, salt: np.ndarray, seed: int = SEED) -> np.ndarray:
    """Image of each index under a pseudorandom permutation of 0 .. size - 1.

    A Feistel network over the next power of four permutes a range that holds the size;
    images outside are permuted again until they fall inside.
    """
    index = index.astype(np.uint64)
    size = size.astype(np.uint64)
    salt = salt.astype(np.uint64) * np.uint64(0x9E3779B9) + np.uint64(seed)
    bits = np.ceil(np.log2(np.maximum(size, 2).astype(float)) / 2).astype(np.uint64)
    bits = np.where(np.uint64(1) << (np.uint64(2) * bits) < size, bits + np.uint64(1), bits)
    half = (np.uint64(1) << bits) - np.uint64(1)

    def turn(x: np.ndarray, which: np.ndarray) -> np.ndarray:
        left, right = x >> bits[which], x & half[which]
        for step in range(4):
            mixed = (right + salt[which] + np.uint64(step * 0x85EBCA6B)) & _MASK
            mixed = ((mixed ^ (mixed >> np.uint64(15))) * np.uint64(0x2C1B3C6D)) & _MASK
            mixed = ((mixed ^ (mixed >> np.uint64(12))) * np.uint64(0x297A2D39)) & _MASK
            mixed ^= mixed >> np.uint64(15)
            left, right = right, left ^ (mixed & half[which])
        return (left << bits[which]) | right

    out = turn(index, np.arange(len(index)))
    while len(wide := np.flatnonzero(out >= size)):
        out[wide] = turn(out[wide], wide)
    return out.astype(np.int64)


def _slots(targets: DataFrame, shards: int, seed: int) -> DataFrame:
    """(number, blocks, shard, first, count): the slots of each source in each shard."""

    def draw(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for number, blocks, slots in frame.itertuples(index=False):
                rng = np.random.default_rng([seed, int(number)])
                left, first = int(slots), 0
                for start in range(0, shards, 65_536):
                    # A part of the shards draws its share of what is left, then each shard.
                    part = min(65_536, shards - start)
                    share = part / (shards - start)
                    own = left if share >= 1 else int(rng.binomial(left, share))
                    counts = rng.multinomial(own, np.full(part, 1 / part))
                    ends = first + np.cumsum(counts)
                    yield pd.DataFrame(
                        {
                            "number": number,
                            "blocks": blocks,
                            "shard": np.arange(start, start + part),
                            "first": ends - counts,
                            "count": counts,
                        }
                    ).query("count > 0")
                    left, first = left - own, first + own

    return targets.select("number", "blocks", "slots").mapInPandas(
        draw, "number bigint, blocks bigint, shard bigint, first bigint, count bigint"
    )


def mixed_blocks(targets: DataFrame, shard_blocks: int = SHARD_BLOCKS, seed: int = SEED) -> DataFrame:
    """(number, shard, block) for every block drawn; a block drawn twice has two rows."""
    total = targets.agg(F.sum("slots")).first()[0] or 0
    drawn = _slots(targets, max(1, -(-int(total) // shard_blocks)), seed)
    slot = F.explode(F.sequence(F.col("first"), F.col("first") + F.col("count") - 1))
    slots = drawn.repartition("number", "shard").select("number", "blocks", "shard", slot.alias("slot"))

    def mapped(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            number, blocks = frame["number"].to_numpy(), frame["blocks"].to_numpy()
            block = permuted(frame["slot"].to_numpy() % blocks, blocks, number, seed)
            yield pd.DataFrame({"number": number, "shard": frame["shard"], "block": block})

    return slots.mapInPandas(mapped, "number bigint, shard bigint, block bigint")


def mix_sources(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    block: int = BLOCK,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    shard_blocks: int = SHARD_BLOCKS,
    seed: int = SEED,
) -> DataFrame:
    """(key, source, size, source_size, target, taken) for every row of ``docs``.

    ``taken`` counts the words of the drawn blocks that are the document's.
    """
    sized = stored(
        docs.select(
            F.col(key).alias("key"),
            F.col(source).cast("string").alias("source"),
            F.size(words_of(text_of(text))).cast("bigint").alias("size"),
        ),
        "sizes",
    )
    rows = sized.count()
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    blocks = F.ceil(F.col("source_size") / block)
    wanted = F.round(F.col("target") * blocks / F.col("source_size")).cast("bigint")
    targets = stored(
        source_targets(totals, weights, share, most)
        .withColumn("blocks", blocks.cast("bigint"))
        .withColumn(
            "slots",
            F.when(
                F.col("source_size") > 0, F.least(wanted, F.col("blocks") * F.lit(most))
            ).otherwise(F.lit(0)),
        ),
        "targets",
    )
    drawn = (
        mixed_blocks(targets.where("slots > 0"), shard_blocks, seed)
        .groupBy("number", "block")
        .agg(F.count(F.lit(1)).alias("times"))
    )
    numbered = stored(
        sized.withColumnRenamed("source", "own")
        .join(targets, F.col("own").eqNullSafe(F.col("source")))
        .select("key", "source", "size", "number", "source_size", "target"),
        "numbered",
    )
    placed = prefix_sums(
        numbered.where("size > 0"), ["number"], ["key", "size"], F.col("size"), "start", rows
    )
    end = F.col("start") + F.col("size")
    touched = F.explode(
        F.sequence(F.floor(F.col("start") / block), F.floor((end - 1) / block))
    )
    whole = ["number", "start", "key", "source", "size", "source_size", "target"]
    taken = (
        placed.withColumn("block", touched)
        .withColumn(
            "words",
            F.least((F.col("block") + 1) * block, end)
            - F.greatest(F.col("block") * block, F.col("start")),
        )
        # The planner takes what is made from the table of targets for as small as that table.
        .join(drawn.hint("merge"), ["number", "block"], "left")
        .groupBy(*whole)
        .agg(F.sum(F.col("words") * F.coalesce("times", F.lit(0))).cast("bigint").alias("taken"))
    )
    empty = numbered.where("size = 0").withColumn("taken", F.lit(0).cast("bigint"))
    columns = ["key", "source", "size", "source_size", "target", "taken"]
    mixed = taken.select(columns).unionByName(empty.select(columns))
    return mixed.withColumnsRenamed({"key": key, "source": source})
