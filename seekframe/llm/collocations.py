"""Collocations: Misra-Gries summaries of n-gram hashes, then an exact second pass.

Texts are cut into pieces at punctuation and line breaks, pieces into words. Every n-gram of
one to ``LONGEST`` words of a language is counted over all texts, in two passes:

1. Tasks count hashes of n-grams over as many blocks of text as a bounded buffer holds, and
   send the counts to the hash partition of each n-gram. A partition merges them in a
   Misra-Gries summary, whose capacity exceeds the partition's share of all n-grams divided
   by the threshold. A compaction takes the same count from every entry, and the total taken
   stays below the threshold: a partition that more mass meets than its share keeps more
   entries instead. So every n-gram that reaches the threshold survives.
2. The survivors' hashes are set in a bit table of at most ``MAX_BITS`` bits, which tasks
   read. N-grams whose bit is set are sent with their words and counted exactly. The table
   only spares work: what passes it by chance is counted and dropped by its count.

Candidates are n-grams of two or more words that reach the threshold. All their parts reach
it too, so scores are joins of the exact counts; products are decimals of 38 digits.

Defined results: a null text counts as empty, a null language as ``und``. Repeated rows count
as often as they occur. A language without candidates has no rows; an empty table gives none.
Only the text and language columns are used.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seekframe.llm.common import stored, text_of
from seekframe.llm.ngrams import blocks, joined, members, mixed, salts, words

LONGEST = 5
MIN_COUNT = 100
TOP = 2000
COVERED_PERCENT = 100
UNKNOWN = "und"

MAX_BITS = 1 << 27
BUFFER = 1 << 21  # entries that a task holds before it sends them
PART_ENTRIES = 1 << 19
MIN_PARTS = 64
KEY_BITS = 48

_ENDS = b".,;:!?\n\x0b\x0c\r"
_END = members(_ENDS)
_OUTSIDE = members(_ENDS + b" \t")
_STEPS = [salts(LONGEST, 11) | np.uint64(1), salts(LONGEST, 12) | np.uint64(1)]
_SIZES = salts(LONGEST, 13)
_HALF = np.uint64(32)
_CUT = np.uint64(64 - KEY_BITS)
_NONE = np.zeros(0, np.uint64)


def _source(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(
        text_of(text).alias("text"), F.coalesce(F.col(lang), F.lit(UNKNOWN)).alias("lang")
    )


class Block:
    """The words of some texts and the hashes of their n-grams."""

    def __init__(self, texts: list[bytes], langs: list[str], hashes: int):
        self.data, begins = joined(texts)
        self.starts, self.ends, self._words = words(self.data, _OUTSIDE, hashes)
        self.row = np.searchsorted(begins, self.starts, side="right") - 1
        self._piece = np.cumsum(_END[self.data], dtype=np.int64)[self.starts]
        own = {name: xxhash.xxh64_intdigest(name.encode()) for name in set(langs)}
        self._salt = np.array([own[name] for name in langs], np.uint64)[self.row]

    def grams(self, size: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """(first words, hashes) of the n-grams of ``size`` words; hashes tell languages apart."""
        count = max(len(self.starts) - size + 1, 0)
        first = np.flatnonzero(self._piece[:count] == self._piece[size - 1 :][:count])
        found = []
        for hashed, step in zip(self._words, _STEPS, strict=False):
            total = self._salt[:count] + _SIZES[size - 1]
            for i in range(size):
                total += hashed[i : i + count] * step[i]
            found.append(mixed(total[first]))
        return first, found


def _blocks(batch: pa.RecordBatch, hashes: int) -> Iterator[tuple[Block, list[str]]]:
    texts = batch.column(0).cast(pa.binary()).to_pylist()
    langs = batch.column(1).to_pylist()
    for low, high in blocks(texts):
        yield Block(texts[low:high], langs[low:high], hashes), langs[low:high]


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with the sums of their counts."""
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    if not len(keys):
        return keys, counts
    first = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1))
    return keys[first], np.add.reduceat(counts, first)


class Summary:
    """Misra-Gries summary that merges counts; what it takes from a count stays below a limit."""

    def __init__(self, capacity: int, threshold: int):
        self.capacity, self.threshold = capacity, threshold
        self.keys, self.counts, self.taken = _NONE, np.zeros(0, np.int64), 0
        self._waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self._size = 0

    def merge(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self._waiting.append((keys, counts))
        self._size += len(keys)
        if self._size > max(self.capacity, len(self.keys)):
            self.compact()

    def compact(self) -> None:
        """Take the count of the entry after the last that fits from all; drop what is empty."""
        parts = [(self.keys, self.counts), *self._waiting]
        self._waiting, self._size = [], 0
        self.keys, self.counts = summed(
            np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts])
        )
        over = len(self.keys) - self.capacity
        if over > 0:
            cut = int(np.partition(self.counts, over - 1)[over - 1])
            cut = min(cut, self.threshold - 1 - self.taken)
            self.taken += cut
            kept = self.counts > cut
            self.keys, self.counts = self.keys[kept], self.counts[kept] - cut

    def survivors(self) -> np.ndarray:
        """Keys whose count may reach the threshold."""
        self.compact()
        return self.keys[self.counts + self.taken >= self.threshold]


def _packed(keys: np.ndarray) -> bytes:
    """Sorted keys, byte by byte of all: the leading ones compress to nothing."""
    planes = keys.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - KEY_BITS // 8 :]
    return np.ascontiguousarray(planes.T).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(KEY_BITS // 8, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, 8 - KEY_BITS // 8 :] = planes.T
    return out.view(">u8").ravel().astype(np.uint64)


def _sent(keys: np.ndarray, counts: np.ndarray, parts: int) -> pa.RecordBatch:
    """Rows (part, keys, counts); keys that occurred once come first and have no counts."""
    part = (keys >> np.uint64(KEY_BITS - 32)) * np.uint64(parts) >> _HALF
    bounds = np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))
    numbers, once, often, times = [], [], [], []
    for number, (low, high) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        if low < high:
            own, count = keys[low:high], counts[low:high]
            numbers.append(number)
            once.append(_packed(own[count == 1]))
            often.append(_packed(own[count > 1]))
            times.append(count[count > 1].astype(np.uint32).tobytes())
    columns = [pa.array(numbers, pa.int32())]
    columns += [pa.array(c, pa.binary()) for c in (once, often, times)]
    return pa.RecordBatch.from_arrays(columns, names=["part", "once", "often", "times"])


def surviving_ngrams(
    docs: DataFrame,
    min_count: int = MIN_COUNT,
    text: str = "text",
    lang: str = "lang",
    longest: int = LONGEST,
    capacity: int | None = None,
) -> DataFrame:
    """(key) of all n-grams that may occur ``min_count`` times, from merged summaries."""
    size = docs.agg(F.sum(F.octet_length(text)), F.count(F.lit(1))).first()
    # A word and what separates it from the next are two bytes at least.
    mass = longest * ((size[0] or 0) + size[1]) // 2
    parts = max(MIN_PARTS, 2 * mass // (min_count * PART_ENTRIES))
    fits = capacity or max(1024, 2 * mass // (min_count * parts) + 1)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for block, _ in _blocks(batch, 1):
                for n in range(1, longest + 1):
                    keys = block.grams(n)[1][0] >> _CUT
                    keys, counts = np.unique(keys, return_counts=True)
                    held.append((keys, counts))
                    size += len(keys)
                if size > BUFFER:
                    held = [summed(*map(np.concatenate, zip(*held, strict=True)))]
                    size = len(held[0][0])
                    if size > BUFFER // 2:
                        yield _sent(*held[0], parts)
                        held, size = [], 0
        if held:
            yield _sent(*summed(*map(np.concatenate, zip(*held, strict=True))), parts)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, summary = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                part, once, often, times = (c[row].as_py() for c in batch.columns)
                if part != current:
                    if summary is not None:
                        yield _keys(summary.survivors())
                    current, summary = part, Summary(fits, min_count)
                single = _unpacked(once)
                summary.merge(single, np.ones(len(single), np.int64))
                summary.merge(_unpacked(often), np.frombuffer(times, np.uint32).astype(np.int64))
        if summary is not None:
            yield _keys(summary.survivors())

    sent = _source(docs, text, lang).mapInArrow(
        counted, "part int, once binary, often binary, times binary"
    )
    dealt = sent.repartition(parts, "part").sortWithinPartitions("part")
    return dealt.mapInArrow(merged, "key bigint")


def _keys(keys: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64), pa.int64())], names=["key"])


def bit_table(keys: DataFrame, max_bits: int = MAX_BITS) -> np.ndarray:
    """A table of at most ``max_bits`` bits, with the bit of every key set."""
    bits = 1 << 16
    wanted = 32 * keys.count()
    while bits < min(wanted, max_bits):
        bits *= 2
    place = F.pmod("key", F.lit(bits))
    masks = (
        keys.select(
            F.floor(place / 64).cast("int").alias("cell"),
            F.expr(f"shiftleft(1L, cast(pmod(key, {bits}) % 64 as int))").alias("mask"),
        )
        .groupBy("cell")
        .agg(F.bit_or("mask").alias("mask"))
        .toArrow()
    )
    out = np.zeros(bits // 64, np.uint64)
    out[masks["cell"].to_numpy()] = masks["mask"].to_numpy().view(np.uint64)
    return out


def _distinct(
    first: np.ndarray, hashed: list[np.ndarray]
) -> tuple[np.ndarray, np.ndarray]:
    """(a first word, count) of each distinct n-gram, told apart by both hashes."""
    if not len(first):
        return first, first
    one, two = hashed
    order = np.argsort(one, kind="stable")
    new = one[order][1:] != one[order][:-1]
    if (~new & (two[order][1:] != two[order][:-1])).any():
        order = np.lexsort((two, one))
        new = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
    bounds = np.concatenate(([0], np.flatnonzero(new) + 1, [len(order)]))
    return first[order[bounds[:-1]]], np.diff(bounds)


def ngram_counts(
    docs: DataFrame,
    survivors: DataFrame,
    text: str = "text",
    lang: str = "lang",
    longest: int = LONGEST,
) -> DataFrame:
    """(lang, size, phrase, f): exact counts of the n-grams among ``survivors``.

    Size 0 holds the number of all words of a language. N-grams that only share a bit with a
    survivor have exact counts too.
    """
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(bit_table(survivors))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = table.value
        bits = np.uint64(len(cells) * 64 - 1)
        six, low = np.uint64(6), np.uint64(63)
        for batch in batches:
            for block, langs in _blocks(batch, 2):
                names = pa.array(langs, pa.string())
                every = pc.value_counts(names.take(pa.array(block.row)))
                yield _counts(
                    every.field("values"), 0, [""] * len(every), every.field("counts").to_numpy()
                )
                data, starts, ends = block.data.tobytes(), block.starts, block.ends
                for n in range(1, longest + 1):
                    first, hashed = block.grams(n)
                    place = (hashed[0] >> _CUT) & bits
                    kept = np.flatnonzero(cells[place >> six] >> (place & low) & np.uint64(1))
                    first, counts = _distinct(first[kept], [h[kept] for h in hashed])
                    phrases = [
                        b" ".join(data[a:b].split())
                        for a, b in zip(
                            starts[first].tolist(), ends[first + n - 1].tolist(), strict=True
                        )
                    ]
                    yield _counts(names.take(pa.array(block.row[first])), n, phrases, counts)

    rows = _source(docs, text, lang).mapInArrow(
        counted, "lang string, size int, phrase string, f bigint"
    )
    return rows.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f"))


def _counts(langs: pa.Array, size: int, phrases: list, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            langs,
            pa.array(np.full(len(phrases), size, np.int32)),
            pa.array(phrases, pa.binary() if size else pa.string()).cast(pa.string()),
            pa.array(counts.astype(np.int64)),
        ],
        names=["lang", "size", "phrase", "f"],
    )


def scored(counts: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase, a, l, r, n, score, size) of all n-grams of two words or more.

    ``counts`` holds every n-gram that is frequent enough, of one word upwards.
    """
    grams = counts.where("size > 0").select("lang", "phrase", F.col("f"))
    cuts = (
        counts.where("size > 1")
        .withColumn("_words", F.split("phrase", " "))
        .withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
        .select(
            "lang",
            "phrase",
            "size",
            F.col("f").alias("a"),
            "k",
            F.array_join(F.slice("_words", F.lit(1), F.col("k")), " ").alias("_left"),
            F.array_join(F.slice("_words", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias(
                "_right"
            ),
        )
    )
    left = grams.select("lang", F.col("phrase").alias("_left"), F.col("f").alias("l"))
    right = grams.select("lang", F.col("phrase").alias("_right"), F.col("f").alias("r"))
    totals = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    joined_cuts = (
        cuts.join(left.hint("merge"), ["lang", "_left"])
        .join(right.hint("merge"), ["lang", "_right"])
        .join(totals, "lang")
    )
    whole = {c: F.col(c).cast("decimal(18,0)") for c in "anlr"}
    above = (F.lit(1000).cast("decimal(4,0)") * whole["a"]).cast("decimal(21,0)") * whole["n"]
    below = whole["l"] * whole["r"]
    exact = joined_cuts.withColumn("_above", above.cast("decimal(38,0)")).withColumn(
        "_below", below.cast("decimal(38,0)")
    )
    cut = F.struct(F.expr("_above div _below").alias("score"), "k", "l", "r")
    lowest = exact.groupBy("lang", "phrase", "size", "a", "n").agg(F.min(cut).alias("_cut"))
    return lowest.select("lang", "phrase", "a", "_cut.l", "_cut.r", "n", "_cut.score", "size")


def without_covered(candidates: DataFrame, percent: int = COVERED_PERCENT) -> DataFrame:
    """Candidates that no longer one holds in ``percent`` of their occurrences or more."""
    inner = F.filter(
        F.flatten(
            F.transform(
                F.sequence(F.lit(2), F.col("size") - 1),
                lambda m: F.transform(
                    F.sequence(F.lit(1), F.col("size") - m + 1),
                    lambda i: F.array_join(F.slice("_words", i, m), " "),
                ),
            )
        ),
        lambda phrase: phrase != "",
    )
    held = (
        candidates.where("size > 2")
        .withColumn("_words", F.split("phrase", " "))
        .select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("_longer"))
        .groupBy("lang", "phrase")
        .agg(F.max("_longer").alias("_longer"))
    )
    met = candidates.join(held.hint("merge"), ["lang", "phrase"], "left")
    covered = F.lit(100) * F.coalesce("_longer", F.lit(0)) >= F.lit(percent) * F.col("a")
    return met.where(~covered).drop("_longer")


def collocations(
    docs: DataFrame,
    min_count: int = MIN_COUNT,
    top: int = TOP,
    text: str = "text",
    lang: str = "lang",
    longest: int = LONGEST,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best ``top`` phrases of every language."""
    survivors = stored(surviving_ngrams(docs, min_count, text, lang, longest), "survivors")
    exact = ngram_counts(docs, survivors, text, lang, longest)
    counts = stored(exact.where((F.col("size") == 0) | (F.col("f") >= min_count)), "ngrams")
    candidates = stored(scored(counts, longest), "collocations")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = without_covered(candidates).withColumn("rank", F.row_number().over(best))
    return ranked.where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
