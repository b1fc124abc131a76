"""Feature hashing (Weinberger et al., 2009): text to vector without a model."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from seekframe.functions.text import tokens

VALUES_AT_ONCE = 1_000_000  # tokens and counts of one block of rows, to bound its memory


def token_hash(token: Column) -> Column:
    """First nine hex digits of the MD5 as a number.

    Seven of them give a token's dimension and the last one its sign, so that any
    engine with MD5 computes the same vector.
    """
    return F.conv(F.substring(F.md5(token), 1, 9), 16, 10).cast("bigint")


def hash_encode(text: Column, dims: int = 64, normalize: bool = True) -> Column:
    """ARRAY<DOUBLE> of ``dims`` signed token counts; of unit length, if ``normalize``.

    Tokens are cut and hashed by Spark expressions; only the histogram of each row
    is counted in an Arrow function, which keeps the operator narrow (exploding the
    tokens would shuffle every text once to put its dimensions back together). A
    text without tokens has no direction and gives NULL when normalised.
    """

    def histogram(hashes):
        sizes = hashes.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        block = np.cumsum(sizes.astype(np.int64) + dims) // VALUES_AT_ONCE
        bounds = [0, *(np.flatnonzero(np.diff(block)) + 1), len(sizes)]
        cut = zip(bounds, bounds[1:])
        return pa.concat_arrays([of_block(hashes.slice(a, b - a), sizes[a:b]) for a, b in cut])

    def of_block(hashes, sizes):
        n = len(hashes)
        row = np.repeat(np.arange(n), sizes)
        code = hashes.flatten().to_numpy(zero_copy_only=False)
        dim = (code >> 8) % dims
        sign = np.where(code & 8, -1.0, 1.0)
        counts = np.bincount(row * dims + dim, weights=sign, minlength=n * dims)
        counts = counts.astype(np.float64).reshape(n, dims)
        length = np.sqrt((counts * counts).sum(axis=1))
        empty = (length == 0) & normalize
        if normalize:
            counts = counts / np.where(length == 0, 1.0, length)[:, None]
        offsets = np.arange(0, (n + 1) * dims, dims, dtype=np.int32)
        return pa.ListArray.from_arrays(
            pa.array(offsets), pa.array(counts.ravel()), mask=pa.array(empty)
        )

    # Declared non-deterministic so that a filter on the vector does not evaluate it twice.
    encoder = F.arrow_udf(histogram, "array<double>").asNondeterministic()
    return encoder(F.transform(tokens(text), token_hash))
