"""Packing of token sequences as a cutting-stock problem, solved by column generation.

A document is its BPE ids and an end mark. What fills whole sequences is cut off in front;
the rest of 1 to 2047 tokens is an item of a length class. How many items each class holds
is the only thing the optimisation sees: a linear program over patterns (numbers of items
per class that fit one sequence) whose columns are found by a knapsack dynamic program. Its
patterns are rounded down, then used again while demand for all their items is left, and
handed to the documents of each class by rank, in tasks. What the rounding leaves over is
bounded by the number of classes, whatever the input; it is laid end to end and cut at
sequence ends, and its last stretch is cut at powers of two, which need no padding.

Defined results: a null text counts as empty and has the end mark only. Repeated rows are
packed as often as they come; a null id is an id like any other. Only the id and text
columns are used. Sequence numbers count from 0; an empty table gives no piece.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from seekframe.llm.bpe import BpeIds
from seekframe.llm.common import prefix_sums, stored, text_of

LENGTH = 2048
GRAIN = 16
END = (1).to_bytes(4, "little")
MAX_ROUNDS = 3_000
GAP = 0.002


def knapsack(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Most valuable multiset of items that fits; its value and the count of each item."""
    best = np.zeros(capacity + 1)
    pick = np.full(capacity + 1, -1)
    order = np.argsort(sizes)
    sizes, values = sizes[order], values[order]
    for room in range(1, capacity + 1):
        fits = np.searchsorted(sizes, room, side="right")
        best[room] = best[room - 1]
        if fits:
            gain = best[room - sizes[:fits]] + values[:fits]
            top = int(np.argmax(gain))
            if gain[top] > best[room] + 1e-12:
                best[room], pick[room] = gain[top], top
    counts, room = np.zeros(len(sizes), np.int64), capacity
    while room > 0:
        if pick[room] < 0:
            room -= 1
            continue
        counts[order[pick[room]]] += 1
        room -= sizes[pick[room]]
    return float(best[capacity]), counts


def column_generation(
    demand: np.ndarray, sizes: np.ndarray, capacity: int, max_rounds: int = MAX_ROUNDS
) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (a row each) and how often to use them, for the least number of sequences.

    Revised simplex over covering constraints: the basis starts with one pattern per class,
    its duals price new patterns, and the pattern of best reduced cost enters. The sequences
    in use divided by the value of that pattern are a lower bound on the optimum, so the
    search ends within ``GAP`` of it; every basis on the way is feasible.
    """
    n = len(sizes)
    basis = np.diag((capacity // sizes).astype(float))
    inverse = np.diag(1.0 / np.diag(basis))
    used = (inverse * demand).sum(axis=1)
    for _ in range(max_rounds):
        prices = inverse.sum(axis=0)
        value, counts = knapsack(np.maximum(prices, 0.0), sizes, capacity)
        if value <= 1.0 + GAP:
            break
        column = counts.astype(float)
        step = (inverse * column).sum(axis=1)
        rising = np.flatnonzero(step > 1e-9)
        if not len(rising):
            break
        ratio = np.maximum(used[rising], 0.0) / step[rising]
        out = rising[int(np.argmin(ratio))]
        basis[:, out] = column
        pivot = inverse[out] / step[out]
        inverse -= np.outer(step, pivot)
        inverse[out] = pivot
        used = (inverse * demand).sum(axis=1)
    return basis.T.round().astype(np.int64).reshape(n, n), np.maximum(used, 0.0)


def rounded(
    patterns: np.ndarray, used: np.ndarray, demand: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers of patterns that never ask for more than the demand, and what is left."""
    left = demand.astype(np.int64).copy()
    times = np.zeros(len(patterns), np.int64)
    floor = np.floor(used + 1e-6).astype(np.int64)
    for limit in (floor, None):  # first the floor, then as often as demand allows
        for p in np.argsort(-(used - floor), kind="stable"):
            needs = patterns[p] > 0
            if not needs.any():
                continue
            most = int((left[needs] // patterns[p][needs]).min())
            if limit is None and patterns[p].sum() < 2:
                continue  # a pattern of one item leaves the end-to-end stretch nothing to gain
            more = most if limit is None else min(most, int(limit[p]))
            times[p] += more
            left -= more * patterns[p]
    return times, left


def with_tokens(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text_hash, tokens, crcs): the CRC of every whole sequence, then of the rest."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = BpeIds()
        for batch in batches:
            sizes, crcs = [], []
            for value in batch.column(2).to_pylist():
                ids = bpe.ids(value) + END
                sizes.append(len(ids) // 4)
                crcs.append(
                    [zlib.crc32(ids[i : i + 4 * LENGTH]) for i in range(0, len(ids), 4 * LENGTH)]
                )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(sizes, pa.int64()),
                    pa.array(crcs, pa.list_(pa.int64())),
                ],
                names=["key", "text_hash", "tokens", "crcs"],
            )

    kind = docs.schema[key].dataType.simpleString()
    source = docs.select(F.col(key).alias("key"), text_of(text).alias("text"))
    return source.select("key", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        counted, f"key {kind}, text_hash bigint, tokens bigint, crcs array<bigint>"
    )


def _assigned(
    patterns: np.ndarray, times: np.ndarray
) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per class: first rank of each pattern's share, items per sequence, first sequence."""
    firsts = np.concatenate(([0], np.cumsum(times)))
    out = {}
    for c in range(patterns.shape[1]):
        rows = np.flatnonzero((patterns[:, c] > 0) & (times > 0))
        shares = times[rows] * patterns[rows, c]
        ends = np.concatenate(([0], np.cumsum(shares)))
        out[c] = (ends, patterns[rows, c], firsts[rows])
    return out


def _stretch(lengths: list[int], first: int) -> list[tuple[int, int, int, int, int]]:
    """(item, start in item, length, sequence, offset) of items laid end to end.

    Sequences are full; the last stretch is cut at powers of two, largest first.
    """
    total = sum(lengths)
    rooms = [LENGTH] * (total // LENGTH)
    rooms += [1 << bit for bit in reversed(range(LENGTH.bit_length())) if total % LENGTH >> bit & 1]
    pieces, room, at = [], 0, 0
    for item, length in enumerate(lengths):
        start = 0
        while start < length:
            take = min(length - start, rooms[room] - at)
            pieces.append((item, start, take, first + room, at))
            start, at = start + take, at + take
            if at == rooms[room]:
                room, at = room + 1, 0
    return pieces


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece."""
    spark = docs.sparkSession
    tokens = stored(with_tokens(docs, key, text), "tokens")
    rest = F.col("tokens") % LENGTH
    sized = tokens.select(
        "key",
        "text_hash",
        "tokens",
        F.floor(F.col("tokens") / LENGTH).alias("whole"),
        rest.alias("rest"),
        F.when(rest > 0, F.element_at("crcs", -1)).alias("rest_crc"),
        F.slice("crcs", 1, F.floor(F.col("tokens") / LENGTH).cast("int")).alias("crcs"),
        F.ceil(rest / GRAIN).cast("int").alias("grains"),
    )
    total = sized.agg(F.count(F.lit(1)), F.sum("whole")).first()
    rows, whole = total[0], total[1] or 0
    counts = {
        r["grains"]: r["count"] for r in sized.where("rest > 0").groupBy("grains").count().collect()
    }
    sizes = np.array(sorted(counts), np.int64)
    demand = np.array([counts[s] for s in sizes], np.int64)
    if len(sizes):
        patterns, used = column_generation(demand.astype(float), sizes, LENGTH // GRAIN)
        times, left = rounded(patterns, used, demand)
    else:
        patterns, times, left = np.zeros((0, 0), np.int64), np.zeros(0, np.int64), demand
    shares = {int(s): v for s, v in zip(sizes, _assigned(patterns, times).values(), strict=True)}

    order = ["key", "text_hash", "tokens"]
    numbered = prefix_sums(sized.where("whole > 0"), [], order, F.col("whole"), "before", rows)
    full = numbered.select(
        "key", "tokens", "before", F.posexplode("crcs").alias("part", "ids_crc32")
    ).select(
        "key",
        (F.col("part") * F.lit(LENGTH)).cast("bigint").alias("start"),
        F.lit(LENGTH).cast("bigint").alias("length"),
        "ids_crc32",
        F.col("tokens").alias("doc_tokens"),
        (F.col("before") + F.col("part")).cast("bigint").alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
    )

    ranked = prefix_sums(
        sized.where("rest > 0").drop("crcs"), ["grains"], order, F.lit(1), "rank", rows
    )

    # Keys stay in Arrow: pandas would turn whole numbers with nulls among them to doubles.
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence = np.full(batch.num_rows, -1, np.int64)
            ranks, classes = batch.column("rank").to_numpy(), batch.column("grains").to_numpy()
            for size in np.unique(classes):
                ends, items, firsts = shares[int(size)]
                own = np.flatnonzero((classes == size) & (ranks < ends[-1]))
                share = np.searchsorted(ends, ranks[own], side="right") - 1
                sequence[own] = firsts[share] + (ranks[own] - ends[share]) // items[share]
            yield batch.append_column("sequence", pa.array(sequence))

    schema = StructType([*ranked.schema.fields, StructField("sequence", LongType())])
    placed = stored(ranked.mapInArrow(place, schema), "packed")
    inside = Window.partitionBy("sequence").orderBy("grains", "rank")
    pieces = (
        placed.where("sequence >= 0")
        .withColumn(
            "offset",
            F.sum("rest").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("rest"),
        )
        .select(
            "key",
            (F.col("tokens") - F.col("rest")).alias("start"),
            F.col("rest").alias("length"),
            F.col("rest_crc").alias("ids_crc32"),
            F.col("tokens").alias("doc_tokens"),
            (F.col("sequence") + F.lit(whole)).alias("sequence_id"),
            "offset",
        )
    )
    # At most one sequence's worth of items per class is left over.
    over = (
        placed.where("sequence < 0")
        .select("key", "text_hash", "tokens", "rest", "grains", "rank")
        .orderBy(F.desc("rest"), "grains", "rank")
        .toArrow()
    )
    cut = _stretch(over["rest"].to_pylist(), whole + int(times.sum()))
    out = full.unionByName(pieces)
    if cut:
        out = out.unionByName(_cut_pieces(spark, docs, over, cut, key, text))
    return out.withColumnRenamed("key", key)


def _cut_pieces(spark, docs, over: pa.Table, cut: list, key: str, text: str) -> DataFrame:
    """Pieces of the documents left over; their ids are made again to be cut anywhere."""
    kind = docs.schema[key].dataType.simpleString()
    rows = []
    owners = list(
        zip(*(over[c].to_pylist() for c in ("key", "text_hash", "tokens", "rest")), strict=True)
    )
    for item, start, length, sequence, offset in cut:
        own, text_hash, tokens, rest = owners[item]
        start = int(tokens - rest + start)
        rows.append((own, text_hash, tokens, start, length, int(sequence), offset))
    wanted = spark.createDataFrame(
        rows,
        f"own {kind}, own_hash bigint, doc_tokens bigint, start bigint, length bigint,"
        " sequence_id bigint, offset bigint",
    )
    piece = F.struct("start", "length", "sequence_id", "offset")
    grouped = wanted.groupBy("own", "own_hash", "doc_tokens").agg(
        F.collect_list(piece).alias("pieces")
    )
    source = docs.select(F.col(key).alias("key"), text_of(text).alias("text")).withColumn(
        "text_hash", F.xxhash64("text")
    )
    met = source.join(
        F.broadcast(grouped),
        source["key"].eqNullSafe(grouped["own"]) & (source["text_hash"] == grouped["own_hash"]),
    )

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = BpeIds()
        for batch in batches:
            row, made = [], []
            texts, cuts = batch.column("text").to_pylist(), batch.column("pieces").to_pylist()
            for i, (value, pieces) in enumerate(zip(texts, cuts, strict=True)):
                ids = bpe.ids(value) + END
                for p in pieces:
                    low = p["start"]
                    crc = zlib.crc32(ids[4 * low : 4 * (low + p["length"])])
                    row.append(i)
                    made.append((low, p["length"], p["sequence_id"], p["offset"], crc))
            own = batch.take(pa.array(row, pa.int64()))
            columns = zip(*made, strict=True) if made else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.array(c, pa.int64()) for c in columns),
                    own.column("key"),
                    own.column("doc_tokens"),
                ],
                names=["start", "length", "sequence_id", "offset", "ids_crc32", "key", "doc_tokens"],
            )

    found = met.select("key", "doc_tokens", "text", "pieces").mapInArrow(
        summed,
        "start bigint, length bigint, sequence_id bigint, offset bigint, ids_crc32 bigint,"
        f" key {kind}, doc_tokens bigint",
    )
    return found.dropDuplicates(["sequence_id", "offset"])
