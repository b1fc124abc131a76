"""Quality classifier on supervised subword embeddings.

A document is the mean of learned vectors of its words, of pairs of neighbouring words and of
character n-grams of 3 to 5 (a blank marks either end of a word), all hashed into ``2 ** BITS`` rows, followed by a
softmax over the two labels. Vectors and output weights are trained together by stochastic
gradient descent in numpy, one document a step, on at most ``max_rows`` labelled documents;
that bound is the only one, and those rows are the first by a hash of their id.

The score is linear in the mean, so a trained model is one number per hashed row: a table of
fixed size that goes to the executors. Whole texts are scored in pieces of bounded size.

Defined results: a null or empty text has no features and gets the share of label 1 that the
output bias learned. Rows are scored one by one; repeated rows stay. Null labels and ids are
not learned from. With labels of one kind only, or none, every text gets the smoothed share of
label 1. Columns other than id and text are never inputs of a score.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BITS = 17
SIZES = (3, 4, 5)
WIDTH = 8
EPOCHS = 4
RATE = 20.0
MAX_ROWS = 2_000
PIECE = 1 << 19
SEED = 5

_STEP = np.uint32(0x01000193)
_SPREAD = np.uint32(0x9E3779B1)
_POWERS = np.array([pow(0x01000193, k, 1 << 32) for k in range(64)], np.uint32)


def _features(points: np.ndarray) -> np.ndarray:
    """Hashed rows of the words and n-grams in code points that start and end with a blank."""
    blank = points == 32
    found = []

    def row(hashes: np.ndarray, kind: int) -> np.ndarray:
        mixed = (hashes ^ (hashes >> np.uint32(15))) + np.uint32(kind * 0x27D4EB2F & 0xFFFFFFFF)
        return (mixed * _SPREAD) >> np.uint32(32 - BITS)

    inside = np.flatnonzero(~blank)
    if not len(inside):
        return np.zeros(0, np.uint32)
    opens = np.flatnonzero(blank[inside - 1])
    at = np.arange(len(inside)) - np.repeat(opens, np.diff(np.append(opens, len(inside))))
    words = np.add.reduceat(points[inside] * _POWERS[np.minimum(at, 63)], opens, dtype=np.uint32)
    found.append(row(words, 1))
    # A pair of words is hashed by the difference of their hashes: all repetitions share a row.
    found.append(row(np.diff(words), 2))
    blanks = np.concatenate(([0], np.cumsum(blank)))
    hashes = points.copy()
    for n in range(2, max(SIZES) + 1):
        if len(points) < n:
            break
        hashes = hashes[: len(points) - n + 1] + points[n - 1 :] * _POWERS[n - 1]
        if n in SIZES:
            # No blank strictly inside the window.
            starts = np.arange(len(hashes))
            clear = blanks[starts + n - 1] == blanks[starts + 1]
            found.append(row(hashes[clear], n))
    return np.concatenate(found)


def features(text: str | None) -> Iterator[np.ndarray]:
    """Hashed rows of a whole text, in pieces that end at blanks."""
    text = " ".join((text or "").split())
    start = 0
    while start < len(text):
        end = start + PIECE
        if end < len(text):
            cut = text.rfind(" ", start, end)
            cut = cut if cut > start else text.find(" ", end)
            end = cut if cut > start else len(text)
        part = f" {text[start:end].strip()} "
        yield _features(np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32))
        start = end


@dataclass(frozen=True)
class QualityModel:
    weights: np.ndarray  # one log-odds contribution per hashed row
    bias: float

    def score(self, text: str | None) -> float:
        total, count = 0.0, 0
        for rows in features(text):
            total += float(self.weights[rows].sum(dtype=np.float64))
            count += len(rows)
        odds = self.bias + (total / count if count else 0.0)
        return float(1.0 / (1.0 + np.exp(-np.clip(odds, -40.0, 40.0))))


def fit(
    examples: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS, rate: float = RATE
) -> QualityModel:
    """Train on (hashed rows, their shares, label) by stochastic gradient descent."""
    rng = np.random.default_rng(SEED)
    rows = 1 << BITS
    ones = sum(label for _, _, label in examples)
    start = np.log((ones + 1.0) / (len(examples) - ones + 1.0))
    if not 0 < ones < len(examples):
        return QualityModel(np.zeros(rows, np.float32), float(start))
    vectors = rng.uniform(-1 / WIDTH, 1 / WIDTH, (rows, WIDTH))
    output, bias = np.zeros((2, WIDTH)), np.array([0.0, start])
    steps = epochs * len(examples)
    for step in range(steps):
        if step % len(examples) == 0:
            order = rng.permutation(len(examples))
        own, shares, label = examples[order[step % len(examples)]]
        pace = 1.0 - step / steps
        met = vectors[own]
        hidden = (met * shares[:, None]).sum(axis=0)
        raw = (output * hidden).sum(axis=1) + bias
        chance = np.exp(raw - raw.max())
        error = chance / chance.sum()
        error[label] -= 1.0
        back = (output * error[:, None]).sum(axis=0)
        output -= pace * np.outer(error, hidden)
        bias -= 0.02 * pace * error
        vectors[own] = met - rate * pace * shares[:, None] * back
    weights = (vectors * (output[1] - output[0])).sum(axis=1)
    return QualityModel(weights.astype(np.float32), float(bias[1] - bias[0]))


def held_out(key: str | Column = "doc_id") -> Column:
    """Rows that are never learned from: crc32 of the id as text leaves 2 when divided by 4."""
    column = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(column.cast("string")) % 4 == 2, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    max_rows: int = MAX_ROWS,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> QualityModel:
    """A model of ``labels.label`` learned from rows that are not held out."""
    sample = (
        labels.select(F.col(key).alias("own"), F.col(label).cast("int").alias("label"))
        .where(F.col("own").isNotNull() & F.col("label").isin(0, 1) & ~held_out("own"))
        .groupBy("own")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("own"), "own")
        .limit(max_rows)
    )
    met = docs.select(F.col(key).alias("own"), F.col(text).alias("text")).join(
        F.broadcast(sample), "own"
    )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, counts = [], []
            for value in batch.column("text").to_pylist():
                total = np.zeros(1 << BITS, np.int64)
                for part in features(value):
                    total += np.bincount(part, minlength=1 << BITS)
                own = np.flatnonzero(total)
                rows.append(own.astype(np.int32))
                counts.append(total[own].astype(np.float32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("own"),
                    batch.column("label"),
                    pa.array(rows, pa.list_(pa.int32())),
                    pa.array(counts, pa.list_(pa.float32())),
                ],
                names=["own", "label", "rows", "counts"],
            )

    kind = docs.schema[key].dataType.simpleString()
    table = (
        met.mapInArrow(counted, f"own {kind}, label int, rows array<int>, counts array<float>")
        .toArrow()
        .combine_chunks()
    )
    examples = []
    keys = table.column("own").to_pylist()
    for at in sorted(range(len(keys)), key=lambda i: (str(keys[i]), len(table["rows"][i]))):
        rows = table["rows"][at].values.to_numpy()
        counts = table["counts"][at].values.to_numpy().astype(float)
        if len(rows):
            examples.append((rows, counts / counts.sum(), table["label"][at].as_py()))
    return fit(examples)


def quality_score(spark: SparkSession, model: QualityModel, text: Column) -> Column:
    """The score of a text column, for use among the other columns of its table."""
    shared = spark.sparkContext.broadcast((model.weights, model.bias))

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        own = QualityModel(*shared.value)
        return pd.Series([own.score(t) for t in texts], dtype=float)

    return scored(text)


def score_quality(
    docs: DataFrame, model: QualityModel, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, score) for every row."""
    score = quality_score(docs.sparkSession, model, F.col(text))
    return docs.select(key, score.alias("score"))
