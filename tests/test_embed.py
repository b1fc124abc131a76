import hashlib

import numpy as np
from pyspark.sql import functions as F

from seekframe.functions.hashing import hash_encode
from seekframe.functions.vectors import (
    checked_width,
    cosine_distance,
    dot,
    l2_normalize,
    vector_literal,
)
from seekframe.operators.embed import encode, mean_pool


def test_hash_encoder_by_hand(spark):
    texts = ["Red, green red", "blue", "", "?!"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in rows.select(
        "doc_id",
        hash_encode(F.col("text"), 16).alias("unit"),
        hash_encode(F.col("text"), 16, normalize=False).alias("raw"),
    ).collect()}
    for i, text in enumerate(texts):
        raw = np.zeros(16)
        for token in text.lower().replace(",", "").replace("?!", "").split():
            digest = hashlib.md5(token.encode()).hexdigest()
            raw[int(digest[:7], 16) % 16] += -1 if digest[8] >= "8" else 1
        assert got[i].raw == raw.tolist()
        if raw.any():
            assert np.allclose(got[i].unit, raw / np.linalg.norm(raw))
        else:
            assert got[i].unit is None


def test_unit_vectors_have_unit_norm_and_dot_is_cosine(spark):
    rng = np.random.default_rng(1)
    rows = spark.createDataFrame(
        [(rng.normal(size=5).tolist(), rng.normal(size=5).tolist()) for _ in range(20)],
        "a array<double>, b array<double>",
    )
    a, b = l2_normalize(F.col("a")), l2_normalize(F.col("b"))
    for r in rows.select(
        dot(a, a).alias("one"),
        (1 - dot(a, b)).alias("d"),
        cosine_distance(F.col("a"), F.col("b")).alias("e"),
    ).collect():
        assert abs(r.one - 1) < 1e-12 and abs(r.d - r.e) < 1e-12


def test_zero_vector_has_no_direction(spark):
    row = spark.sql("SELECT array(0.0D, 0.0D) z, array(1.0D, 0.0D) v").select(
        l2_normalize(F.col("z")).alias("n"), cosine_distance(F.col("z"), F.col("v")).alias("d")
    ).first()
    assert row.n is None and row.d is None


def test_literal_and_width(spark):
    row = spark.sql("SELECT array(1e-9F, -2.5F) v")
    assert row.select(vector_literal(F.col("v"))).first()[0] == "[0.000000,-2.500000]"
    try:
        row.select(checked_width(F.col("v"), 384)).collect()
        raise AssertionError("width was not checked")
    except Exception as e:
        assert "not 384 wide" in str(e)


def test_encoder_plugs_in_and_runs_once_per_row(spark):
    def make():
        return lambda texts: np.array([[len(t), 1] for t in texts.ravel()], dtype=np.float32)

    rows = spark.createDataFrame([("abc",), ("",)], "text string")
    encoded = rows.select("text", encode(F.col("text"), make).alias("vec")).where("vec is not null")
    assert {r.text: r.vec for r in encoded.collect()} == {"abc": [3.0, 1.0], "": [0.0, 1.0]}
    plan = encoded._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") + plan.count("BatchEvalPython") == 1


def test_mean_pool_masks_tokens(spark):
    rows = spark.createDataFrame(
        [
            (1, 1, [1.0, 2.0]),
            (1, 1, [3.0, 4.0]),
            (1, 0, [9.0, 9.0]),
            (2, 1, [5.0, 6.0]),
            (3, 0, [7.0, 7.0]),
        ],
        "doc_id long, mask int, vec array<float>",
    )
    got = {r.doc_id: r.vec for r in mean_pool(rows, "doc_id").collect()}
    assert got == {1: [2.0, 3.0], 2: [5.0, 6.0]}
