import numpy as np
import pytest

from seekframe.operators.growth import bounded_search, compact, create_index, grow, open_index
from seekframe.operators.vector import vector_search
from seekframe.sources.tables import _versions

ROWS = "doc_id long, label int, vec array<float>"


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(11)
    middles = rng.normal(size=(12, 6))
    near = [(middles[i % 12] + 0.08 * rng.normal(size=6)).tolist() for i in range(600)]
    # A third of all rows are copies of one vector, and one has no direction.
    return [(i, i % 4, near[i] if i % 3 else near[0]) for i in range(600)] + [(600, 0, [0.0] * 6)]


def table(spark, rows):
    return spark.createDataFrame(rows, ROWS)


def queries(spark, rows):
    asked = [(i, v) for i, _, v in rows[::60]]
    return spark.createDataFrame(asked, "query_id long, vec array<float>")


def found(hits):
    return sorted((r.query_id, r["rank"], r.doc_id, r.score) for r in hits.collect())


def live(index):
    return sorted((r.doc_id, r.label, tuple(r.vec)) for r in index.vectors.collect())


def steps(spark, rows, path):
    """Half of the rows, the other half, some deleted, one changed, one deleted and back."""
    changed = [(5, 9, rows[100][2]), (8, 8, rows[8][2])]
    create_index(table(spark, rows[:300]), path, cells=12)
    grow(path, added=table(spark, rows[300:]))
    grow(path, deleted=table(spark, [r for r in rows if r[0] % 7 == 1] + [(10**9, 0, None)]))
    grow(path, added=table(spark, changed), deleted=table(spark, [rows[3]]))
    grow(path, added=table(spark, [rows[3]]))
    final = {r[0]: r for r in rows if r[0] % 7 != 1} | {r[0]: r for r in [*changed, rows[3]]}
    return list(final.values())


def test_grown_equals_built_anew(spark, rows, tmp_path):
    path, asked = str(tmp_path / "grown"), queries(spark, rows)
    final = steps(spark, rows, path)
    built = create_index(table(spark, final), str(tmp_path / "new"), cells=12)
    exact = found(vector_search(table(spark, final), asked, 5))
    assert live(open_index(spark, path)) == live(built)
    assert found(bounded_search(open_index(spark, path), asked)[0]) == exact
    compact(spark, path)
    after = open_index(spark, path)
    assert live(after) == live(built)
    assert found(bounded_search(after, asked)[0]) == exact
    assert "_segment" not in after.vectors._jdf.queryExecution().optimizedPlan().toString()
    grow(path, deleted=table(spark, final[:50]))
    gone = {r[0] for r in final[:50]}
    assert live(open_index(spark, path)) == [r for r in live(built) if r[0] not in gone]


def test_steps_beside_a_compaction_stay(spark, rows, tmp_path, monkeypatch):
    """A step committed after the compaction's snapshot is applied on top of the new base."""
    from seekframe.operators import growth

    path = str(tmp_path / "x")
    create_index(table(spark, rows[:100]), path, cells=4)
    grow(path, added=table(spark, rows[100:120]))
    write = growth._write_segment

    def late(*args):
        out = write(*args)
        monkeypatch.setattr(growth, "_write_segment", write)
        grow(path, added=table(spark, rows[200:210]), deleted=table(spark, rows[:5]))
        return out

    monkeypatch.setattr(growth, "_write_segment", late)
    compact(spark, path)
    assert {d for d, _, _ in live(open_index(spark, path))} == {*range(5, 120), *range(200, 210)}


def test_bounds_leave_cells_out(spark, rows, tmp_path):
    index = create_index(table(spark, rows), str(tmp_path / "x"), cells=12)
    asked = queries(spark, rows)
    hits, probes = bounded_search(index, asked, 5, first=1)
    assert found(hits) == found(vector_search(table(spark, rows), asked, 5))
    assert probes.count() < 0.5 * asked.count() * index.cells
    # More hits than rows: nothing can be left out.
    assert found(bounded_search(index, asked, 1000)[0]) == found(vector_search(table(spark, rows), asked, 1000))


def test_empty_and_wrong_steps(spark, rows, tmp_path):
    path = str(tmp_path / "x")
    create_index(table(spark, rows[:50]), path, cells=3)
    grow(path, added=table(spark, []), deleted=table(spark, []))
    assert len(live(open_index(spark, path))) == 50
    with pytest.raises(ValueError, match="twice"):
        grow(path, added=table(spark, [rows[60], rows[60]]))
    with pytest.raises(ValueError, match="there is an index"):
        create_index(table(spark, rows[:50]), path, cells=3)
    with pytest.raises(ValueError, match="nothing to add"):
        grow(path)
    # The failed step was never published.
    assert len(live(open_index(spark, path))) == 50 and len(_versions(spark, f"{path}/log")) == 2
    grow(path, deleted=table(spark, rows[:50]))
    assert live(open_index(spark, path)) == []
    assert bounded_search(open_index(spark, path), queries(spark, rows))[0].count() == 0
