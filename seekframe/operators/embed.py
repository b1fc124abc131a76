"""Encoding texts with a model of the caller's, and pooling token vectors."""

from collections.abc import Callable

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from seekframe.functions.hashing import hash_encode
from seekframe.functions.text import tokens

# Fixed value: texts handed to the model at a time.
BATCH_SIZE = 50


def encode(
    text: Column,
    make_encoder: Callable[[], Callable[[np.ndarray], np.ndarray]],
    batch_size: int = BATCH_SIZE,
) -> Column:
    """Vector of each text from a pluggable encoder, ARRAY<FLOAT>.

    ``make_encoder`` loads the model and runs once per Python worker; the function
    it returns maps an array of texts to a matrix with one row per text.
    """
    udf = predict_batch_udf(
        make_encoder, return_type=ArrayType(FloatType()), batch_size=batch_size
    )
    # Declared non-deterministic so that a filter on the vector does not run the model twice.
    return udf.asNondeterministic()(text)


def token_rows(
    docs: DataFrame, key: str = "doc_id", text: str = "text", dims: int = 64
) -> DataFrame:
    """``(key, pos, mask, vec)``: the tokens of each text in order, with a vector each.

    A token's vector is its hashed feature; a model's own token vectors can take its place.
    """
    rows = docs.select(key, F.posexplode(tokens(F.col(text))).alias("pos", "token"))
    return rows.select(key, "pos", F.lit(1).alias("mask"), hash_encode(F.col("token"), dims).alias("vec"))


def mean_pool(token_rows: DataFrame, by: str, vec: str = "vec", mask: str = "mask") -> DataFrame:
    """``(by, vec)``: mean of the vectors whose ``mask`` is 1, dimension by dimension.

    Sums are combined per dimension before the shuffle, so a ``by`` group of any size
    leaves a task as one row per dimension. A group that is masked out entirely has no
    mean and is left out.
    """
    kept = F.col(mask).cast("double")
    mean = F.sum(F.col("_v").cast("double") * kept) / F.nullif(F.sum(kept), F.lit(0.0))
    return (
        token_rows.select(by, mask, F.posexplode(vec).alias("_dim", "_v"))
        .groupBy(by, "_dim")
        .agg(mean.alias("_v"))
        .where(F.col("_v").isNotNull())
        .groupBy(by)
        .agg(F.array_sort(F.collect_list(F.struct("_dim", "_v"))).alias("_vs"))
        .select(by, F.transform("_vs", lambda x: x["_v"]).alias("vec"))
    )
