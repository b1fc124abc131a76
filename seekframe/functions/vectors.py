"""Expressions over ARRAY<FLOAT|DOUBLE> columns, computed in double."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cos(a, b); NULL when either vector is all zero."""
    return 1 - dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def l2_normalize(v: Column) -> Column:
    """Scale to unit length; NULL for a zero vector."""
    length = F.nullif(norm(v), F.lit(0.0))
    return F.when(length.isNotNull(), F.transform(v, lambda x: x.cast("double") / length))


def vector_literal(v: Column, decimals: int = 6) -> Column:
    """``[x,y,...]`` with fixed decimals, the text form vector databases load."""
    items = F.transform(v, lambda x: F.format_string(f"%.{decimals}f", x))
    return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))


def checked_width(v: Column, width: int) -> Column:
    """The vector, failing the job if it is NULL or of another width."""
    return F.when(F.size(v) == width, v).otherwise(
        F.raise_error(F.lit(f"vector is NULL or not {width} wide"))
    )
