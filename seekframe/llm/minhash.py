"""MinHash near-duplicates by fast similarity sketching, banding and exact verification.

A text is the set of its distinct four-word shingles. Its sketch has ``BANDS * ROWS``
coordinates. In round i every shingle is thrown into one of the coordinates by a hash of the
round, with a value that starts at i; a coordinate keeps its least value. A round that finds
all coordinates filled is the last. After as many rounds as coordinates, round
``coordinates + b`` throws every shingle into coordinate b, so each is filled whatever the
size of the set. Two sets agree at a coordinate with the probability of their Jaccard
similarity, concentrated as if coordinates were drawn without replacement, and a sketch
costs the size of the set plus c log c, not their product.

Sets that agree in one of the bands of ``ROWS`` coordinates meet in a bucket: at similarity
0.8 all bands miss with probability 5e-7. No bucket is expanded into its pairs:

1. Each set of a bucket is compared with the bucket's least set. Links make components.
2. A bucket whose other sets are of one component has nothing left to find. In the rest,
   sets outside the largest component are compared with all sets of the bucket, in tiles of
   a bounded number of sets; a tile pair returns a spanning forest of its links.

Both compare whole sets, exactly. A pair that neither step compares is of one component
already, so the components are those of all links that any band finds.

Defined results: a null text counts as empty; a text without words has no shingles and links
with nothing, so it is its own component; fewer words than a shingle make one shingle.
Repeated rows stay. Rows with a null id are in the component of their group; a group that
has no other id has a null component, and its rows are kept. Only the id and text columns
are used.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seekframe.llm.common import stored, text_of
from seekframe.llm.components import components
from seekframe.llm.ngrams import SPACES, blocks, joined, members, mixed, salts, words

SHINGLE = 4
PERCENT = 80
BANDS = 48
ROWS = 6
SPAN = 512  # sets compared with one copy of a bucket's least set
TILE = 1024

_OUTSIDE = members(SPACES)
_PLACES = salts(SHINGLE, 1) | np.uint64(1)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_LOW = np.uint64(0xFFFFFFFF)
_HALF = np.uint64(32)


def shingle_sets(texts: list[bytes], shingle: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted hashes of the distinct shingles of each text."""
    places = _PLACES if shingle == SHINGLE else salts(shingle, 1) | np.uint64(1)
    for first, last in blocks(texts):
        data, begins = joined(texts[first:last])
        starts, _, (hashed,) = words(data, _OUTSIDE)
        bounds = np.searchsorted(starts, np.append(begins, len(data)))
        grams = np.zeros(max(len(hashed) - shingle + 1, 0), np.uint64)
        for i in range(shingle):
            grams += hashed[i : i + len(grams)] * places[i]
        grams = mixed(grams)
        for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if high - low >= shingle:
                yield np.unique(grams[low : high - shingle + 1])
            elif high > low:
                size = high - low
                whole = (hashed[low:high] * places[:size]).sum(keepdims=True)
                yield mixed(whole ^ np.uint64(size))
            else:
                yield np.zeros(0, np.uint64)


def sketch(hashes: np.ndarray, coordinates: int = BANDS * ROWS) -> np.ndarray:
    """Fast similarity sketch of a set that is not empty."""
    rounds = salts(2 * coordinates, 2) if coordinates != BANDS * ROWS else _ROUNDS
    out = np.full(coordinates, _EMPTY)
    enough = coordinates * (np.log(coordinates) + 1.5)
    at_once = int(max(1, np.ceil(enough / len(hashes))))
    for first in range(0, coordinates, at_once):
        # Rounds beyond the last needed change nothing: their values are larger.
        number = np.arange(first, min(first + at_once, coordinates))
        drawn = mixed(hashes[None, :] ^ rounds[number][:, None])
        place = ((drawn >> _HALF) * np.uint64(coordinates)) >> _HALF
        value = (drawn & _LOW) | (number.astype(np.uint64) << _HALF)[:, None]
        np.minimum.at(out, place.ravel().astype(np.int64), value.ravel())
        if (out != _EMPTY).all():
            return out
    for place in np.flatnonzero(out == _EMPTY):
        drawn = mixed(hashes ^ rounds[coordinates + place])
        out[place] = (drawn & _LOW).min() | np.uint64((coordinates + int(place)) << 32)
    return out


_ROUNDS = salts(2 * BANDS * ROWS, 2)
_SEEDS = salts(BANDS, 3)


def band_keys(coordinates: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One hash per band, of its number and its coordinates."""
    cut = coordinates.reshape(bands, -1)
    out = _SEEDS.copy() if bands == BANDS else salts(bands, 3)
    for row in range(cut.shape[1]):
        out = mixed(out ^ cut[:, row])
    return out.view(np.int64)


def with_sketches(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text_hash, node, n, bands) per row; node is a digest of the set, null if empty."""

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sizes, bands = [], [], []
            for hashes in shingle_sets(batch.column(2).cast(pa.binary()).to_pylist()):
                sizes.append(len(hashes))
                nodes.append(xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None)
                bands.append(band_keys(sketch(hashes)) if len(hashes) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(nodes, pa.binary()),
                    pa.array(sizes, pa.int64()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                names=["key", "text_hash", "node", "n", "bands"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return _sources(docs, key, text).mapInArrow(
        sketched, f"key {kind}, text_hash bigint, node binary, n bigint, bands array<bigint>"
    )


def _sources(docs: DataFrame, key: str, text: str) -> DataFrame:
    source = docs.select(F.col(key).alias("key"), text_of(text).alias("text"))
    return source.select("key", F.xxhash64("text").alias("text_hash"), "text")


def _buckets(nodes: DataFrame) -> DataFrame:
    """(bucket, node, center, size) of all buckets of two sets or more.

    Of buckets with the same sets one is taken: near copies share most of their bands.
    """
    filed = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = (
        filed.groupBy("bucket")
        .agg(
            F.min("node").alias("center"),
            F.max("node").alias("last"),
            F.count(F.lit(1)).alias("size"),
            F.bit_xor(F.xxhash64("node")).alias("sets"),
        )
        .where("center != last")
    )
    once = shared.groupBy("center", "last", "size", "sets").agg(F.min("bucket").alias("bucket"))
    return filed.join(once.select("bucket", "center", "size").hint("merge"), "bucket")


def _whole_sets(docs: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """(node, hashes) of the sets in ``wanted`` (node, rep), cut once more from one text each."""
    source = _sources(docs, key, text)
    asked = wanted.select("node", F.col("rep.key").alias("own"), F.col("rep.text_hash").alias("h"))
    met = source.join(
        asked.hint("merge"),
        (source["text_hash"] == asked["h"]) & source["key"].eqNullSafe(asked["own"]),
    )
    # Rows repeat; the first text of each task goes on.
    texts = met.groupBy("node").agg(F.first("text").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column(1).cast(pa.binary()).to_pylist())
            held = [h.view(np.int64) for h in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(held, pa.list_(pa.int64()))], names=["node", "hashes"]
            )

    return texts.mapInArrow(cut, "node binary, hashes array<bigint>")


def _star_links(buckets: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between sets and the least sets of their buckets.

    The least set of a large bucket is copied once for every ``SPAN`` sets or so.
    """
    pairs = (
        buckets.where("node != center")
        .groupBy("node", "center")
        .agg(F.ceil(F.max("size") / SPAN).cast("int").alias("spans"))
        .withColumn("span", F.pmod(F.xxhash64("node"), F.col("spans")).cast("int"))
    )
    copies = pairs.select("center", "spans", "span").distinct()
    centers = copies.join(
        sets.select(F.col("node").alias("center"), F.col("hashes").alias("theirs")).hint("merge"),
        "center",
    )
    compared = pairs.join(sets.hint("merge"), "node").join(
        centers.hint("merge"), ["center", "spans", "span"]
    )
    common = F.size(F.array_intersect("hashes", "theirs"))
    union = F.size("hashes") + F.size("theirs") - common
    linked = F.lit(100) * common >= F.lit(percent) * union
    return compared.where(linked).select(F.col("node").alias("a"), F.col("center").alias("b"))


def forest(probes: list, filed: list, probe_sets: list, filed_sets: list, percent: int) -> list:
    """Spanning forest of the links between two lists of distinct sets."""
    sizes = np.fromiter(map(len, filed_sets), np.int64, len(filed_sets))
    owner = np.repeat(np.arange(len(filed_sets)), sizes)
    every = np.concatenate(filed_sets) if filed_sets else np.zeros(0, np.int64)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    root: dict = {}

    def find(node):
        while (up := root.setdefault(node, node)) != node:
            root[node] = root[up]
            node = root[node]
        return node

    links = []
    for name, hashes in zip(probes, probe_sets, strict=True):
        low = np.searchsorted(every, hashes, side="left")
        times = np.searchsorted(every, hashes, side="right") - low
        at = np.repeat(low - np.cumsum(times) + times, times) + np.arange(times.sum())
        common = np.bincount(owner[at], minlength=len(sizes))
        near = 100 * common >= percent * (sizes + len(hashes) - common)
        for i in np.flatnonzero(near):
            a, b = find(name), find(filed[i])
            if a != b:
                root[max(a, b)] = min(a, b)
                links.append((name, filed[i]))
    return links


def _tile_links(
    buckets: DataFrame, labels: DataFrame, sets: DataFrame, percent: int, tile: int
) -> DataFrame | None:
    """Links that the stars leave open, or None if every bucket is of one component."""
    # The least set of a bucket has met all others of it.
    rest = buckets.where("node != center").join(labels.hint("merge"), "node", "left")
    rest = rest.select("bucket", "node", F.coalesce("root", "node").alias("label"))
    per_label = rest.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
    per_bucket = (
        per_label.groupBy("bucket")
        .agg(
            F.max_by("label", F.struct("n", "label")).alias("major"),
            F.max("n").alias("most"),
            F.sum("n").alias("size"),
        )
        .where("size > most")
        .select(
            "bucket",
            "major",
            F.ceil(F.col("size") / tile).cast("int").alias("filed_tiles"),
            F.ceil((F.col("size") - F.col("most")) / tile).cast("int").alias("probe_tiles"),
        )
    )
    per_bucket = stored(per_bucket, "open-buckets")
    if per_bucket.isEmpty():
        return None
    opened = stored(rest.join(per_bucket.hint("merge"), "bucket"), "open-sets")

    def tiled(rows: DataFrame, probe: bool) -> DataFrame:
        mine, others = ("probe", "filed") if probe else ("filed", "probe")
        own = F.pmod(F.xxhash64("node"), F.col(f"{mine}_tiles")).cast("int")
        other = F.explode(F.sequence(F.lit(0), F.col(f"{others}_tiles") - 1))
        return rows.select(
            "node",
            "bucket",
            own.alias(mine),
            other.alias(others),
            F.lit(probe).alias("asks"),
        ).select("node", "bucket", "filed", "probe", "asks")

    rows = tiled(opened, False).unionByName(tiled(opened.where("label != major"), True))
    placed = rows.join(sets.hint("merge"), "node")

    def linked(table: pa.Table) -> pa.Table:
        asks = table["asks"].to_numpy()
        names = table["node"].to_pylist()
        held = table["hashes"].combine_chunks()
        ends = held.offsets.to_numpy()
        flat = held.values.to_numpy()
        lists = [flat[ends[i] : ends[i + 1]] for i in range(len(names))]
        own, other = np.flatnonzero(asks), np.flatnonzero(~asks)
        links = forest(
            [names[i] for i in own],
            [names[i] for i in other],
            [lists[i] for i in own],
            [lists[i] for i in other],
            percent,
        )
        return pa.table(
            {
                "a": pa.array([a for a, _ in links], pa.binary()),
                "b": pa.array([b for _, b in links], pa.binary()),
            }
        )

    return placed.groupBy("bucket", "filed", "probe").applyInArrow(linked, "a binary, b binary")


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    percent: int = PERCENT,
    tile: int = TILE,
) -> DataFrame:
    """(key, n_shingles, component_id, kept) for every row.

    component_id is the smallest key of the group; kept marks the rows that hold it.
    """
    prints = stored(with_sketches(docs, key, text), "minhash")
    nodes = stored(
        prints.where("node is not null")
        .groupBy("node")
        .agg(
            F.min("key").alias("least"),
            F.min(F.struct("key", "text_hash")).alias("rep"),
            F.first("bands").alias("bands"),
        ),
        "minhash-nodes",
    )
    buckets = stored(_buckets(nodes), "minhash-buckets")
    wanted = buckets.select("node").distinct().join(nodes.select("node", "rep"), "node")
    sets = stored(_whole_sets(docs, wanted, key, text), "minhash-sets")
    links = stored(_star_links(buckets, sets, percent), "minhash-links")
    labels = stored(components(links), "minhash-labels")
    more = _tile_links(buckets, labels, sets, percent, tile)
    if more is not None:
        more = stored(more.distinct(), "minhash-more")
        if not more.isEmpty():
            labels = components(links.unionByName(more))
    rooted = nodes.select("node", "least").join(labels.hint("merge"), "node", "left")
    rooted = rooted.select("node", "least", F.coalesce("root", "node").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    label = rooted.join(least.hint("merge"), "root").select("node", "component_id")
    grouped = prints.join(label.hint("merge"), "node", "left")
    own = F.when(F.col("node").isNull(), F.col("key")).otherwise(F.col("component_id"))
    return grouped.select(
        F.col("key").alias(key),
        F.col("n").alias("n_shingles"),
        own.alias("component_id"),
        F.col("key").eqNullSafe(own).alias("kept"),
    )
