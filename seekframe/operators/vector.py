"""Vector search: a stored table of vectors against a table of query vectors.

Every query is compared with every vector it may match. Doing that by a join would
emit one row per pair, so the scoring runs on Arrow batches instead: a batch of
vectors is multiplied with the matrix of queries, and each query keeps those
rows that are among the best k the task has met. What leaves a task is little more
than k rows per query, vectors are read where they lie and never shuffled, and a
value shared by any number of vectors is spread over as many tasks as its rows are.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from seekframe.operators.rank import top_k
from seekframe.session import slices, union_all

LISTED_VALUES = 1_000  # more are joined: a predicate of that length is slow to plan
QUERIES_AT_ONCE = 512  # columns of a score block, to bound its memory


def vector_search(
    vectors: DataFrame,
    queries: DataFrame,
    num_results: int = 5,
    key: tuple[str, ...] = ("doc_id",),
    on: tuple[str, ...] = (),
    metric: str = "cosine",
    similarity: str = "score",
    query_rows: int | None = None,
    slice_rows: int = 16_384,
    probes: DataFrame | None = None,
) -> DataFrame:
    """``(query_id, *key, score, rank)``: the nearest vectors for each query.

    ``vectors`` holds ``(*key, *on, vec)``, ``queries`` holds ``(query_id, *on, vec)``;
    a query meets only vectors with equal ``on`` columns, and may have several rows to
    look at several values. ``metric`` is ``cosine`` or ``dot``. NULL vectors match
    nothing, nor do zero vectors under ``cosine``. Scores are rounded to 6 places, ties
    go to the smaller key.

    Queries are broadcast as a matrix of about ``slice_rows`` rows; larger tables go out
    in slices, one scan of ``vectors`` each. ``query_rows`` is the number of rows in
    ``queries``, or a bound on it, and is counted if not given.

    ``probes`` is ``(query_id, name)`` for an ``on`` column ``name`` that ``queries`` lacks:
    the values that each row of the query looks at. A vector then goes out once, not once
    per value.
    """
    if metric not in ("cosine", "dot"):
        raise ValueError(f"unknown metric {metric}")
    spark = vectors.sparkSession
    listed = None
    if probes is not None:
        listed = next(c for c in probes.columns if c != "query_id")
        looks_at = probes.groupBy("query_id").agg(F.collect_list(listed).alias(listed))
        queries = queries.join(looks_at, "query_id")
    wanted = queries.dropna(subset=["vec", *on]).select("query_id", *on, "vec")
    stored = vectors.where(F.col("vec").isNotNull()).select(*key, *on, "vec")
    schema = StructType(
        [
            queries.schema["query_id"],
            *[vectors.schema[k] for k in key],
            StructField("score", DoubleType()),
        ]
    )
    if query_rows is None:
        query_rows = queries.count()
    scored = []
    for part in slices(wanted, "query_id", query_rows, slice_rows):
        table = part.toArrow()
        groups = _groups(table, on, listed)
        shared = spark.sparkContext.broadcast(
            (table["query_id"].combine_chunks(), _matrix(table["vec"], metric), groups)
        )
        if listed is not None:
            part = part.withColumn(listed, F.explode(listed))
        candidates = _may_match(stored, part, groups, on)
        best = _best_of_batches(shared, key, on, metric, num_results)
        scored.append(candidates.mapInArrow(best, schema))
    hits = top_k(union_all(scored), num_results, [F.desc("score"), *map(F.asc, key)])
    return hits.withColumnRenamed("score", similarity)


def _groups(table: pa.Table, on: tuple[str, ...], listed: str | None) -> dict[tuple, np.ndarray]:
    """The rows of queries by their ``on`` values, of which the column ``listed`` holds many."""
    own: dict[tuple, list[int]] = {}
    if listed is None:
        for i, value in enumerate(_rows(table, on)):
            own.setdefault(value, []).append(i)
        return {value: np.array(rows, np.int32) for value, rows in own.items()}
    others = tuple(c for c in on if c != listed)
    codes = [own.setdefault(value, len(own)) for value in _rows(table, others)]
    lists = table[listed].combine_chunks()
    row = pc.list_parent_indices(lists).to_numpy().astype(np.int32)
    code = np.array(codes, np.int32)[row]
    encoded = lists.flatten().dictionary_encode()
    value = encoded.indices.to_numpy(zero_copy_only=False)
    order = np.lexsort((row, value, code))
    row, value, code = row[order], value[order], code[order]
    changes = np.flatnonzero((np.diff(value) != 0) | (np.diff(code) != 0)) + 1
    names, given = encoded.dictionary.to_pylist(), list(own)
    groups = {}
    for rows, at in zip(np.split(row, changes), [0, *changes]):
        if len(rows):
            named = dict(zip(others, given[code[at]])) | {listed: names[value[at]]}
            groups[tuple(named[c] for c in on)] = rows
    return groups


def _may_match(
    stored: DataFrame, part: DataFrame, groups: dict[tuple, np.ndarray], on: tuple[str, ...]
) -> DataFrame:
    """Stored rows whose ``on`` values some query asks for.

    Few values reach the scan as a predicate. More are joined, which prunes partitions at
    run time; they come from one slice of queries, whose size is bounded.
    """
    for i, name in enumerate(on):
        values = {g[i] for g in groups}
        if len(values) <= LISTED_VALUES:
            stored = stored.where(F.col(name).isin(sorted(values)))
        else:
            stored = stored.join(F.broadcast(part.select(name).distinct()), name, "left_semi")
    return stored


def _rows(table, columns: tuple[str, ...]) -> Iterator[tuple]:
    if not columns:
        return iter([()] * table.num_rows)
    return zip(*[table[c].to_pylist() for c in columns])


def _matrix(column, metric: str):
    n = len(column)
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if n == 0:
        return flat.reshape(0, 0)
    widths = pc.min_max(pc.list_value_length(column))
    if widths["min"] != widths["max"]:
        raise ValueError("vectors differ in width")
    x = flat.reshape(n, -1)
    if metric == "cosine":
        length = np.sqrt((x * x).sum(axis=1, keepdims=True))
        x = np.divide(x, length, out=np.full_like(x, np.nan), where=length > 0)
    return x


def _best_of_batches(shared, key: tuple[str, ...], on: tuple[str, ...], metric: str, k: int):
    """Function for ``mapInArrow``: the best k rows of every batch for every query."""

    def best(batches):
        ids, matrix, groups = shared.value
        reached = np.full((len(matrix), k), -np.inf)  # best scores so far, worst of them first
        for batch in batches:
            if batch.num_rows == 0 or len(matrix) == 0:
                continue
            # Rows in key order make every later "first of the best" the smallest key.
            table = pa.Table.from_batches([batch]).sort_by([(c, "ascending") for c in key])
            x = _matrix(table["vec"], metric)
            if x.shape[1] != matrix.shape[1]:
                raise ValueError(f"vectors are {x.shape[1]} wide, queries {matrix.shape[1]}")
            members = {} if on else {(): np.arange(table.num_rows)}
            for i, value in enumerate(_rows(table, on) if on else ()):
                members.setdefault(value, []).append(i)
            for value, rows in members.items():
                asked = np.array(groups.get(value, []), dtype=np.int64)
                rows = np.array(rows)
                for at in range(0, len(asked), QUERIES_AT_ONCE):
                    block = asked[at : at + QUERIES_AT_ONCE]
                    scores = np.round(x[rows] @ matrix[block].T, 6)
                    so_far = reached[block]
                    chosen, owner = first_k(scores, so_far)
                    reached[block] = so_far
                    if len(chosen) == 0:
                        continue
                    taken = table.select(list(key)).take(pa.array(rows[chosen])).combine_chunks()
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.take(pa.array(block[owner])),
                            *[taken[c].combine_chunks() for c in key],
                            pa.array(scores[chosen, owner] + 0.0),
                        ],
                        names=["query_id", *key, "score"],
                    )

    return best


def first_k(scores, reached):
    """Row and column numbers of each column's best k rows that match what was reached.

    The earlier row wins ties. ``reached`` holds k scores per column in ascending order
    and is brought up to date; NaN scores are never chosen.
    """
    k = reached.shape[1]
    bar = np.maximum(reached[:, 0], np.finfo(np.float64).min)
    near_any = scores >= bar
    rows, columns = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for j in np.flatnonzero(near_any.any(axis=0)):
        near = np.flatnonzero(near_any[:, j])
        values = scores[near, j]
        if len(near) > k:
            best = values >= np.partition(values, len(near) - k)[len(near) - k]
            near, values = near[best], values[best]
        order = np.argsort(-values, kind="stable")[:k]
        reached[j] = np.sort(np.concatenate([reached[j], values[order]]))[-k:]
        rows.append(near[order])
        columns.append(np.full(len(order), j))
    return np.concatenate(rows), np.concatenate(columns)
