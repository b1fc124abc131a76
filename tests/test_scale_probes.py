"""Vector search with probes: each query vector goes out once."""

import numpy as np

from seekframe.operators.vector import vector_search


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def test_vectors_go_out_once_however_many_cells_they_probe(spark, monkeypatch):
    rng = np.random.default_rng(3)
    stored = spark.createDataFrame(
        [(i, i % 7, "ab"[i % 2], rng.normal(size=4).tolist()) for i in range(90)],
        "doc_id long, cell int, kind string, vec array<double>",
    )
    rows = [(q, "ab"[q % 2], rng.normal(size=4).tolist()) for q in (1, 2, 3, 3)]
    queries = spark.createDataFrame(rows, "query_id long, kind string, vec array<double>")
    probes = spark.createDataFrame(
        [(q, c) for q in (1, 2, 3) for c in range(q, 7)], "query_id long, cell int"
    )
    for on in (("cell",), ("cell", "kind"), ("kind", "cell")):
        wide = vector_search(stored, queries.join(probes, "query_id"), 5, on=on)
        once = vector_search(stored, queries, 5, on=on, probes=probes)
        assert rows_of(once) == rows_of(wide) and once.count()
    assert vector_search(stored, queries, 5, on=("cell",), probes=probes.limit(0)).count() == 0
