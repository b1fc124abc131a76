"""SimHash fingerprints of word shingles and near-duplicate groups by pigeonring filtering.

A fingerprint has 64 bits: bit b is set if it is set in more than half of the XXH64 values
of the text's three-word shingles, repeats included. Two fingerprints link at three or
fewer differing bits, and groups are the connected components of the links.

Candidates come from the pigeonring principle. The 64 bits form a ring of four segments of
16. If two fingerprints differ in at most three bits, some segment starts a chain whose
first l segments differ in at most l * 3 / 4 bits for every l: none in the first, at most
one in two, at most two in three. So a fingerprint is filed under its segments i and i + 1
for every i, and looked up there and under each variant of segment i + 1 with one bit
turned on; that meets the conditions for l = 1 and 2 exactly, and those for l = 3 and 4 are
checked on the few candidates that remain.

Equal fingerprints are one node. A key with many nodes is cut into tiles that are compared
pairwise in tasks of their own, and each comparison returns a spanning forest of its links
in place of all pairs, which leaves the components as they are.

Defined results: a null text counts as empty; a text without words has fingerprint zero and
links like any other; fewer words than a shingle make one shingle. Repeated rows stay. Rows
with a null id have a fingerprint and the component of their group; a group that has no
other id has a null component. Only the id and text columns are used.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seekframe.llm.common import stored
from seekframe.llm.components import components

BITS = 64
SEGMENTS = 4
WIDTH = BITS // SEGMENTS
MAX_DIFF = 3
SHINGLE = 3
SEED = 42
TILE = 2048

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit number."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = np.array([digest(joined, SEED)], dtype=np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate(([0], ends[:-shingle])).tolist()
        stops = (ends[shingle - 1 :] - 1).tolist()
        hashes = np.fromiter(
            (digest(joined[s:e], SEED) for s, e in zip(starts, stops, strict=True)),
            np.uint64,
            len(starts),
        )
    set_bits = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 65_536):
        part = hashes[start : start + 65_536].view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * set_bits > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def with_fingerprint(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp) for every row; fp is the fingerprint as a signed number."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [simhash(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints, pa.int64())], names=["key", "fp"]
            )

    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(key, text).mapInArrow(hashed, f"key {kind}, fp bigint")
    return out.select(F.col("key").alias(key), "fp")


def _turned(fp: Column, segment: int) -> Column:
    """The ring of bits turned so that ``segment`` is on top."""
    by = segment * WIDTH
    if by == 0:
        return fp
    return F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, BITS - by))


def _keys(fp: Column, probes: bool) -> Column:
    """Keys (segment number, its bits and those of the next) under which to file or look up.

    Looking up also turns on each bit of the second segment that is off: of two nodes that
    differ in one bit there, the one without it finds the other.
    """
    keys = []
    for segment in range(SEGMENTS):
        top = F.shiftrightunsigned(_turned(fp, segment), 2 * WIDTH)
        number = F.lit(segment << (2 * WIDTH))
        keys.append(top.bitwiseOR(number))
        if probes:
            for bit in range(WIDTH):
                off = top.bitwiseAND(F.lit(1 << bit)) == 0
                keys.append(F.when(off, top.bitwiseOR(number).bitwiseOR(F.lit(1 << bit))))
    return F.filter(F.array(*keys), lambda k: k.isNotNull()) if probes else F.array(*keys)


def _viable(a: Column, b: Column, key: Column) -> Column:
    """Chains of three and four segments stay within their budgets."""
    x = a.bitwiseXOR(b)
    segment = F.shiftright(key, 2 * WIDTH)
    chain = None
    for number in range(SEGMENTS):
        three = F.bit_count(F.shiftrightunsigned(_turned(x, number), WIDTH))
        within = three <= 3 * MAX_DIFF // SEGMENTS
        chain = (F if chain is None else chain).when(segment == number, within)
    return chain & (F.bit_count(x) <= MAX_DIFF)


def _forest(pdf: pd.DataFrame) -> pd.DataFrame:
    """Spanning forest of the links between filed nodes and probes of one tile pair."""
    filed = pdf.loc[~pdf["probe"], "fp"].to_numpy(np.int64).view(np.uint64)
    probes = pdf.loc[pdf["probe"], "fp"].to_numpy(np.int64).view(np.uint64)
    root: dict[int, int] = {}

    def find(node: int) -> int:
        while (up := root.setdefault(node, node)) != node:
            root[node] = root[up]
            node = root[node]
        return node

    edges = []
    for start in range(0, len(probes), 256):
        block = probes[start : start + 256]
        linked = np.bitwise_count(block[:, None] ^ filed[None, :]) <= MAX_DIFF
        for i, j in zip(*np.nonzero(linked), strict=True):
            a, b = find(int(block[i])), find(int(filed[j]))
            if a != b:
                root[max(a, b)] = min(a, b)
                edges.append((int(block[i]), int(filed[j])))
    made = np.array(edges, np.uint64).reshape(-1, 2).view(np.int64)
    return pd.DataFrame({"a": made[:, 0], "b": made[:, 1]})


def links(nodes: DataFrame, tile: int = TILE) -> DataFrame:
    """Links (a, b) between the distinct values of ``nodes.fp``.

    Every linked pair is returned, except under keys of more than ``tile`` nodes, where a
    spanning forest of the pairs is. Either way the components are those of all links.
    """
    filed = nodes.select("fp", F.explode(_keys(F.col("fp"), False)).alias("key"))
    probes = nodes.select("fp", F.explode(_keys(F.col("fp"), True)).alias("key"))
    hot = (
        filed.groupBy("key")
        .count()
        .where(F.col("count") > tile)
        .select("key", F.ceil(F.col("count") / tile).cast("int").alias("tiles"))
    )
    hot = stored(hot, "hot-keys")
    crowded = not hot.isEmpty()
    if crowded:
        some_filed, some_probes = (x.join(hot, "key", "left_anti") for x in (filed, probes))
    else:
        some_filed, some_probes = filed, probes
    # The planner takes the keys of a node for no larger than the node: never broadcast them.
    pairs = some_probes.select("key", F.col("fp").alias("a")).join(
        some_filed.select("key", F.col("fp").alias("b")).hint("merge"), "key"
    )
    found = pairs.where(
        (F.col("a") != F.col("b")) & _viable(F.col("a"), F.col("b"), F.col("key"))
    ).select("a", "b")
    if not crowded:
        return found

    def tiled(rows: DataFrame, probe: bool) -> DataFrame:
        own = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
        other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
        placed = rows.join(hot, "key").withColumn("own", own).withColumn("other", other)
        first, second = ("other", "own") if probe else ("own", "other")
        return placed.select(
            "key",
            F.col(first).alias("filed_tile"),
            F.col(second).alias("probe_tile"),
            "fp",
            F.lit(probe).alias("probe"),
        )

    tiles = tiled(filed, False).unionByName(tiled(probes, True))
    dense = tiles.groupBy("key", "filed_tile", "probe_tile").applyInPandas(
        _forest, "a bigint, b bigint"
    )
    return found.unionByName(dense)


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", tile: int = TILE
) -> DataFrame:
    """(key, fp, component_id) for every row; component_id is the smallest key of the group."""
    prints = stored(with_fingerprint(docs, key, text), "simhash")
    nodes = stored(prints.groupBy("fp").agg(F.min(key).alias("least")), "simhash-nodes")
    stars = components(links(nodes, tile))
    rooted = nodes.join(stars, nodes["fp"] == stars["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    label = rooted.join(least, "root").select("fp", "component_id")
    return prints.join(label, "fp").select(key, "fp", "component_id")
