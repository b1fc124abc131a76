import numpy as np
import pytest

from seekframe.operators.ann import (
    assign_cells,
    build_ivf_index,
    ivf_search,
    kmeans_centres,
    nprobe_for,
    open_ivf_index,
)
from seekframe.operators.vector import vector_search

VECTORS = "doc_id long, label int, vec array<float>"
QUERIES = "query_id long, label int, vec array<float>"


def brute_force(stored, queries, k, metric="cosine", same_label=False):
    hits = set()
    for query_id, q_label, q in queries:
        ranked = []
        for doc_id, label, v in stored:
            if v is None or q is None or (same_label and label != q_label):
                continue
            a, b = np.float32(q).astype(float), np.float32(v).astype(float)
            score = a @ b
            if metric == "cosine":
                length = np.linalg.norm(a) * np.linalg.norm(b)
                if length == 0:
                    continue
                score /= length
            ranked.append((-round(score, 6), doc_id))
        hits |= {(query_id, d, -s, r) for r, (s, d) in enumerate(sorted(ranked)[:k], 1)}
    return hits


def as_set(hits):
    return {(r.query_id, r.doc_id, r.score, r.rank) for r in hits.collect()}


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(7)
    stored = [(i, i % 3, rng.normal(size=8).tolist()) for i in range(400)]
    # A third of the rows are copies of one vector, and some have no direction.
    copy = rng.normal(size=8).tolist()
    stored += [(1000 + i, 1, copy) for i in range(200)]
    stored += [(2000, 0, [0.0] * 8), (2001, 1, None)]
    queries = [(i, i % 3, rng.normal(size=8).tolist()) for i in range(9)]
    return stored, queries + [(9, 1, copy), (10, 0, [0.0] * 8), (11, 0, None)]


@pytest.fixture(scope="module")
def frames(spark, rows):
    stored, queries = rows
    return spark.createDataFrame(stored, VECTORS), spark.createDataFrame(queries, QUERIES)


@pytest.mark.parametrize("metric", ["cosine", "dot"])
@pytest.mark.parametrize("k", [1, 5, 1000])
def test_exact(rows, frames, metric, k):
    assert as_set(vector_search(*frames, k, metric=metric)) == brute_force(*rows, k, metric)


def test_small_batches_and_slices_change_nothing(spark, rows, frames):
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = as_set(vector_search(*frames, 5, slice_rows=4))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    assert got == brute_force(*rows, 5)


def test_filter_by_the_query_s_own_value(rows, frames):
    got = as_set(vector_search(*frames, 5, on=("label",)))
    assert got == brute_force(*rows, 5, same_label=True)


def test_filter_is_the_ranking_restricted(rows, frames):
    stored, queries = frames
    everything = as_set(vector_search(*frames, 10_000))
    labels = {d: label for d, label, _ in rows[0]}
    for q in range(9):
        kept = sorted((r, d, s) for i, d, s, r in everything if i == q and labels[d] == 2)[:5]
        one = vector_search(stored.where("label = 2"), queries.where(f"query_id = {q}"), 5)
        assert [(d, s) for _, d, s in kept] == [
            (h.doc_id, h.score) for h in one.orderBy("rank").collect()
        ]


def test_empty_sides(frames):
    stored, queries = frames
    assert vector_search(stored.limit(0), queries).count() == 0
    assert vector_search(stored, queries.limit(0)).count() == 0
    assert vector_search(stored, queries.limit(0), on=("label",)).count() == 0


def test_widths_must_agree(spark, frames):
    narrow = spark.createDataFrame([(1, 0, [1.0, 2.0])], QUERIES)
    with pytest.raises(Exception, match="wide"):
        vector_search(frames[0], narrow).collect()


def test_filter_reaches_the_scan(spark, frames, tmp_path):
    path = str(tmp_path / "v")
    frames[0].write.parquet(path)
    hits = vector_search(spark.read.parquet(path), frames[1], on=("label",))
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "In(label, [0,1,2])" in plan
    assert plan.count("Exchange") == 1 and "WindowGroupLimit" in plan.split("Exchange")[1]


@pytest.fixture(scope="module")
def ivf(frames, tmp_path_factory):
    return build_ivf_index(frames[0], str(tmp_path_factory.mktemp("ivf") / "x"), cells=6)


def with_direction(rows):
    return [r for r in rows[0] if r[2] is not None], rows[1]


def test_all_cells_probed_is_exact(rows, frames, ivf):
    assert as_set(ivf_search(ivf, frames[1], 5, ivf.cells)) == brute_force(*with_direction(rows), 5)


def test_recall_does_not_fall_with_more_cells(rows, frames, ivf):
    exact = {(q, d) for q, d, _, _ in brute_force(*with_direction(rows), 5)}
    found = [
        len(exact & {(q, d) for q, d, _, _ in as_set(ivf_search(ivf, frames[1], 5, n))})
        for n in range(1, ivf.cells + 1)
    ]
    assert found == sorted(found) and found[-1] == len(exact)


def test_filtered_and_reopened(spark, rows, frames, tmp_path):
    build_ivf_index(frames[0], str(tmp_path / "x"), cells=4)
    again = open_ivf_index(spark, str(tmp_path / "x"))
    got = as_set(ivf_search(again, frames[1], 5, again.cells, on=("label",)))
    assert got == brute_force(*with_direction(rows), 5, same_label=True)


def test_only_probed_cells_are_read(frames, ivf):
    one = frames[1].where("query_id = 0")
    plan = ivf_search(ivf, one, 5, 1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cell" in plan or "PartitionFilters: [(cell" in plan
    assert " = " in plan[plan.index("PartitionFilters") :].split("]")[0]


def test_same_seed_same_centres(frames):
    first, second = (kmeans_centres(frames[0], 5, seed=42).collect() for _ in range(2))
    assert first == second


def test_nearest_cell_and_ties(spark):
    centres = spark.createDataFrame(
        [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [2.0, 0.0])], "cell int, vec array<double>"
    )
    stored = spark.createDataFrame(
        [(1, [3.0, 1.0]), (2, [1.0, 3.0]), (3, [1.0, 1.0])], "doc_id long, vec array<double>"
    )
    cells = {r.doc_id: r.cell for r in assign_cells(stored, centres).collect()}
    assert cells == {1: 0, 2: 1, 3: 0}


def test_nprobe_from_measured_recall(rows, frames, ivf):
    exact = vector_search(frames[0], frames[1], 5)
    best = {(r.query_id, r.doc_id) for r in exact.collect()}

    def recall(n):
        return len(best & {(q, d) for q, d, _, _ in as_set(ivf_search(ivf, frames[1], 5, n))}) / len(best)

    chosen = nprobe_for(ivf, frames[1], exact, 0.9)
    assert recall(chosen) >= 0.9 and (chosen == 1 or recall(chosen - 1) < 0.9)


def test_kmeans_query_asks_for_nine_tenths():
    from registered import queries

    assert queries.IVF_RECALL >= 0.9
