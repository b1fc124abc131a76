"""Overlapping chunks of a text."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def chunk_documents(
    docs: DataFrame, text: str = "text", size: int = 2000, step: int = 1000
) -> DataFrame:
    """One row per window of ``size`` code points, windows starting every ``step``.

    The text column is replaced by ``start`` and ``content``; all other columns are
    carried along. The last window is the first one that reaches the end of the
    text, so no window lies inside its predecessor, and a text no longer than
    ``size`` gives one chunk.

    The text is cut once into pieces of ``step``; a window is a run of whole pieces and the
    start of the next. A ``substring`` of the text per window would count code points from
    its start each time, which is quadratic in the length of long texts.
    """
    if not size >= step > 0:
        raise ValueError("size >= step > 0 is required")
    whole, rest = divmod(size, step)

    others = [c for c in docs.columns if c != text]
    body = F.coalesce(F.col(text), F.raise_error(F.lit(f"NULL in text column {text}")))
    pieces = F.regexp_extract_all(body, F.lit(f"(?s).{{1,{step}}}"), F.lit(0))
    cut = docs.select(*others, pieces.alias("_pieces"), F.length(body).alias("_length"))
    last = F.greatest(F.lit(0), F.ceil((F.col("_length") - size) / F.lit(step))).cast("int")

    def content(i):
        full = F.array_join(F.slice("_pieces", i + 1, whole), "")
        if not rest:
            return full
        return F.concat(full, F.substring(F.coalesce(F.get("_pieces", i + whole), F.lit("")), 1, rest))

    windows = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.struct(
            (i.cast("long") * step).alias("start"),
            content(i).alias("content"),
        ),
    )
    return cut.select(*others, F.inline(windows))
