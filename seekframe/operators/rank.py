"""Ranking: top-k per query, and dense numbering that survives a hot group."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seekframe.functions.text import all_present


def top_k(scored: DataFrame, k: int, order: list[Column], by: str = "query_id") -> DataFrame:
    """Keep the first ``k`` rows per ``by`` and number them from 1 in ``rank``.

    Spark cuts each partition to k rows per query before the exchange
    (WindowGroupLimit), so what is shuffled does not grow with the candidates.
    """
    w = Window.partitionBy(by).orderBy(*order)
    ranked = scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.withColumn("rank", F.col("rank").cast("long"))


def attach_payload(
    hits: DataFrame, docs: DataFrame, columns: list[str], key: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """Hits with ``columns`` of the stored records they name.

    Only those columns of ``docs`` are read; a record without a hit costs no exchange if
    Spark finds the hits small enough to broadcast, which it decides when they are there.
    """
    clash = set(columns) & (set(hits.columns) - set(key))
    if clash:
        raise ValueError(f"payload named like a column of the hits: {sorted(clash)}")
    payload = docs.select(*key, *[c for c in columns if c not in key])
    return hits.join(payload, list(key))


def dense_number(
    rows: DataFrame, by: str, order: str, start: DataFrame, name: str, span: int = 10_000
) -> DataFrame:
    """Number the rows of each ``by`` group in the order of ``order``, in column ``name``.

    ``order`` must be a whole number, unique within its group. ``start(by, first)``
    gives the first number of a group; a group that is not listed starts at 0.

    A plain ``row_number()`` would put a group into one task whatever its size. Here the
    rows are cut into runs of about ``span`` by quantiles of ``order``, however sparse its
    values are: the runs are counted first, their running totals give each run its offset,
    and rows are numbered within their run only. A NULL in ``by`` or ``order`` fails the job.
    """
    rows = rows.where(all_present(by, order))
    runs = math.ceil(rows.count() / span)
    steps = [i / runs for i in range(1, runs)]
    placed = rows.select(F.col(order).cast("double").alias("_at"))
    cuts = placed.approxQuantile("_at", steps, 1 / (4 * runs)) if steps else []
    bounds = np.unique(np.array(cuts, float))

    @F.pandas_udf("int")
    def run_of(values: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, values.to_numpy(float), side="right"), dtype="int32")

    cut = rows.withColumn("_run", run_of(F.col(order)) if runs > 1 else F.lit(0))
    earlier = Window.partitionBy(by).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy(by, "_run")
        .agg(F.count("*").alias("_n"))
        .join(start.select(by, "first"), by, "left")
        .select(
            by,
            "_run",
            (F.coalesce("first", F.lit(0)) + F.coalesce(F.sum("_n").over(earlier), F.lit(0))).alias(
                "_offset"
            ),
        )
    )
    within = F.row_number().over(Window.partitionBy(by, "_run").orderBy(order))
    return (
        cut.join(offsets, [by, "_run"])
        .withColumn(name, (F.col("_offset") + within - 1).cast("long"))
        .drop("_run", "_offset")
    )
