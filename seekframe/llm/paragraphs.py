"""Document fingerprints that can be subtracted: invertible Bloom lookup sketches.

A text is cut into paragraphs (its lines, and lines of more than ``WORDS`` words into runs of
that many), and each paragraph has a 64-bit digest; the n-th repetition of a paragraph has a
digest of its own. A sketch adds every digest to one cell in each of three parts: a cell
holds a count, a sum of digests and a sum of checks. Subtracting the sketches of two versions
leaves the digests in which they differ. Peeling takes them out one after another from cells
that hold a single one; if it gets stuck, both texts are sketched again in four times as many
cells, until it succeeds. The likeness of two texts is 1 less the share of all their
paragraphs that was peeled.

The fingerprint is the sketch in the smallest number of cells, as text. Equal texts have
equal fingerprints.

Defined results: a null text counts as empty; a text without words has an empty sketch, and
two of those have likeness 1. Versions and neighbours are by descending id, equal ids by
text; a null id comes last. Repeated rows stay and are each other's neighbours. Only the id
and text columns are used. An empty table has no rows.
"""

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seekframe.llm.common import text_of

WORDS = 8
PARTS = 3
CELLS = 8  # per part, in the smallest sketch
GROWTH = 4
ROWS_AT_ONCE = 64

_CHECK = np.uint64(0x9E3779B97F4A7C15)
_SALTS = tuple(np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB))


def _mixed(x: np.ndarray, salt: np.uint64) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * salt
    return x ^ (x >> np.uint64(29))


def digests(text: str) -> np.ndarray:
    """Distinct digests of the paragraphs of a text, in order."""
    paragraphs = []
    for line in text.split("\n"):
        words = line.split()
        if len(words) <= WORDS:
            if words:
                paragraphs.append(" ".join(words))
        else:
            paragraphs.extend(
                " ".join(words[i : i + WORDS]) for i in range(0, len(words), WORDS)
            )
    hashed = xxhash.xxh64_intdigest
    found = np.fromiter(
        (hashed(p.encode("utf-8", "surrogatepass")) for p in paragraphs), np.uint64, len(paragraphs)
    )
    order = np.argsort(found, kind="stable")
    ranked = found[order]
    fresh = np.concatenate(([True], ranked[1:] != ranked[:-1])) if len(found) else found == 0
    if not fresh.all():
        starts = np.flatnonzero(fresh)
        again = np.arange(len(found)) - np.repeat(starts, np.diff(np.append(starts, len(found))))
        times = np.empty(len(found), np.uint64)
        times[order] = again.astype(np.uint64)
        found = np.where(times > 0, _mixed(found + times, _SALTS[0]), found)
    return found


def sketches(owner: np.ndarray, keys: np.ndarray, sign: np.ndarray, rows: int, cells: int):
    """Counts, digest sums and check sums of ``rows`` sketches of ``cells`` cells a part."""
    count = np.zeros(rows * PARTS * cells, np.int64)
    total = np.zeros(rows * PARTS * cells, np.uint64)
    check = np.zeros(rows * PARTS * cells, np.uint64)
    signed = sign.astype(np.int64).astype(np.uint64)
    checks = _mixed(keys, _CHECK)
    for part in range(PARTS):
        at = _cell(owner, keys, part, cells)
        np.add.at(count, at, sign)
        np.add.at(total, at, keys * signed)
        np.add.at(check, at, checks * signed)
    return count, total, check


def _cell(owner: np.ndarray, keys: np.ndarray, part: int, cells: int) -> np.ndarray:
    inside = (_mixed(keys, _SALTS[part]) % np.uint64(cells)).astype(np.int64)
    return (owner * PARTS + part) * cells + inside


def peel(count: np.ndarray, total: np.ndarray, check: np.ndarray, cells: int):
    """(peeled digests per sketch, whether nothing is left in it); the arrays are used up."""
    width = PARTS * cells
    rows = len(count) // width
    peeled = np.zeros(rows, np.int64)
    active = np.flatnonzero(np.abs(count) == 1)
    while len(active):
        sign = count[active]
        keys = total[active] * sign.astype(np.uint64)
        good = (np.abs(sign) == 1) & (
            _mixed(keys, _CHECK) * sign.astype(np.uint64) == check[active]
        )
        owner, keys, sign = active[good] // width, keys[good], sign[good]
        if not len(keys):
            break
        # A digest alone in several of its cells is peeled once.
        order = np.lexsort((keys, owner))
        owner, keys, sign = owner[order], keys[order], sign[order]
        first = np.concatenate(
            ([True], (owner[1:] != owner[:-1]) | (keys[1:] != keys[:-1]))
        )
        owner, keys, sign = owner[first], keys[first], sign[first]
        np.add.at(peeled, owner, 1)
        touched = []
        taken = (-sign).astype(np.uint64)
        for part in range(PARTS):
            at = _cell(owner, keys, part, cells)
            np.add.at(count, at, -sign)
            np.add.at(total, at, keys * taken)
            np.add.at(check, at, _mixed(keys, _CHECK) * taken)
            touched.append(at)
        active = np.unique(np.concatenate(touched))
        active = active[np.abs(count[active]) == 1]
    left = (count != 0) | (total != 0)
    return peeled, ~left.reshape(rows, width).any(axis=1)


def likeness(firsts: list[np.ndarray], seconds: list[np.ndarray]) -> np.ndarray:
    """Likeness of each pair of digest lists, by subtracting sketches and peeling."""
    sizes = np.array([len(a) + len(b) for a, b in zip(firsts, seconds, strict=True)], np.int64)
    out = np.ones(len(firsts))
    open_, cells = np.flatnonzero(sizes > 0), CELLS
    while len(open_):
        mine, other = [firsts[i] for i in open_], [seconds[i] for i in open_]
        lengths = [len(x) for x in mine] + [len(x) for x in other]
        owner = np.repeat(np.tile(np.arange(len(open_)), 2), lengths)
        keys = np.concatenate([*mine, *other])
        sign = np.repeat(
            np.array([1, -1]), [sum(lengths[: len(open_)]), sum(lengths[len(open_) :])]
        )
        peeled, done = peel(*sketches(owner, keys, sign, len(open_), cells), cells)
        ended = open_[done]
        out[ended] = 1.0 - peeled[done] / sizes[ended]
        open_, cells = open_[~done], cells * GROWTH
    return out


def fingerprint(keys: np.ndarray) -> str:
    """The smallest sketch as text: per cell a count, a digest sum and half a check sum."""
    count, total, check = sketches(
        np.zeros(len(keys), np.int64), keys, np.ones(len(keys), np.int64), 1, CELLS
    )
    cells = np.zeros(PARTS * CELLS, np.dtype([("n", "<u4"), ("sum", "<u8"), ("check", "<u4")]))
    cells["n"], cells["sum"] = count, total
    cells["check"] = check >> np.uint64(32)
    return base64.b64encode(cells.tobytes()).decode("ascii")


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the start of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _described(key: pa.Array, texts: list[str]) -> pa.RecordBatch:
    """Rows for all texts but the last, each with the one after it."""
    versions = [edited(a, b) for a, b in zip(texts, texts[1:], strict=False)]
    own = [digests(t) for t in texts]
    new = [digests(t) for t in versions]
    prints = [fingerprint(d) for d in own[:-1]]
    return pa.RecordBatch.from_arrays(
        [
            key,
            pa.array([len(t) for t in texts[:-1]], pa.int64()),
            pa.array(
                [hashlib.sha256(v.encode("utf-8", "surrogatepass")).hexdigest() for v in versions]
            ),
            pa.array(prints),
            pa.array([fingerprint(d) for d in new]),
            pa.array(likeness(own[:-1], new)),
            pa.array(likeness(own[:-1], own[1:])),
        ],
        names=["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint"]
        + ["near_edited", "near_next"],
    )


def _with_next(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Describe sorted rows (key, text, stretch, guest); a guest row ends its stretch."""
    held: list[tuple] = []

    def flush(keep: tuple | None) -> Iterator[pa.RecordBatch]:
        if len(held) > 1:
            yield _described(pa.array([h[0] for h in held[:-1]], kind), [h[1] for h in held])
        held.clear()
        if keep is not None:
            held.append(keep)

    size = 0
    for batch in batches:
        kind = batch.column(0).type
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            _, text, stretch, guest = row
            if held and held[-1][2] != stretch:
                raise ValueError("a stretch of rows has no row to end it")
            held.append(row)
            size += len(text)
            if guest:
                yield from flush(None)
                size = 0
            elif len(held) > ROWS_AT_ONCE or size > 1 << 22:
                yield from flush(row)
                size = len(text)


def document_versions(
    docs: DataFrame, key: str = "doc_id", text: str = "text", stretches: int | None = None
) -> DataFrame:
    """(key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    Rows are dealt out by ranges of the id, so texts move once. The first row of every range
    goes to the range before it as well, as the guest that follows its last row; the first
    row of all follows the last.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(key).alias("key"), text_of(text).alias("text"))
    if stretches is None:
        stretches = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    steps = [i / stretches for i in range(1, stretches)]
    cuts = sorted(set(source.approxQuantile("key", steps, 1 / (4 * stretches)))) if steps else []
    bounds = np.array(cuts, float)

    @F.pandas_udf("int")
    def stretch_of(ids: pd.Series) -> pd.Series:
        place = np.searchsorted(bounds, ids.to_numpy(float, na_value=-np.inf), side="right")
        return pd.Series(len(bounds) - place, dtype="int32")

    stretch = stretch_of(F.col("key").cast("double"))
    placed = source.withColumn("stretch", stretch)
    # One row per stretch: its first id. Their number is the number of stretches.
    heads = sorted(
        (r["stretch"], r["key"])
        for r in source.select("key")
        .withColumn("stretch", stretch)
        .groupBy("stretch")
        .agg(F.max("key").alias("key"))
        .collect()
    )
    before = [heads[i - 1][0] for i in range(len(heads))]
    kind = source.schema["key"].dataType.simpleString()
    sent = spark.createDataFrame(
        [(head[1], to) for head, to in zip(heads, before, strict=True)], f"head {kind}, to int"
    )
    guests = (
        source.join(F.broadcast(sent), F.col("key").eqNullSafe(F.col("head")))
        .groupBy("to")
        .agg(F.max("key").alias("key"), F.min("text").alias("text"))
        .select("key", "text", F.col("to").alias("stretch"), F.lit(True).alias("guest"))
    )
    rows = placed.withColumn("guest", F.lit(False)).unionByName(guests)
    ordered = rows.repartition(
        int(spark.conf.get("spark.sql.shuffle.partitions")), "stretch"
    ).sortWithinPartitions("stretch", "guest", F.desc_nulls_last("key"), "text")
    schema = (
        f"key {kind}, n_chars bigint, edited_sha256 string, fingerprint string,"
        " edited_fingerprint string, near_edited double, near_next double"
    )
    return ordered.mapInArrow(_with_next, schema).withColumnRenamed("key", key)
