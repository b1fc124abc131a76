"""Fill-in-the-middle rearrangement over seekable compressed texts.

A text is stored as zstandard frames that are independent of one another, each with the
units (words with the white space before them; white space at the end is a unit) that have
ended and the code points that have passed before it. To cut a text after a number of units,
the counts name the frame of the cut, and only that frame is decompressed. The rearranged
text is made of the stored frames as they are, in another order, with the marks and the
halves of the cut frames as frames of their own. Digests stream the frames in order, so a
text is never held in one piece after it has been stored.

Draws come from the id alone, so reruns agree and equal rows are rearranged alike.

Defined results: a null text counts as empty; an empty text stays plain with no units, as
does a text that holds a mark. A null id draws like the id ``null``. Repeated rows stay.
Only the id and text columns are used. An empty table has no rows.
"""

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seekframe.llm.common import text_of

FRAME = 1 << 16
LEVEL = 3
SEED = 42
FIM_PERCENT = 50
SPM_PERCENT = 80
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"

_SPACES = b" \t\n\x0b\x0c\r"
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_ROWS_BYTES = 1 << 23
_FRAME = [("units", pa.int64()), ("chars", pa.int64()), ("open", pa.bool_()), ("data", pa.binary())]
_STORED = pa.list_(pa.struct(_FRAME))
_OUTPUT = pa.list_(pa.binary())
STORED_TYPE = "array<struct<units: bigint, chars: bigint, open: boolean, data: binary>>"


def code_points(data: bytes) -> int:
    return len(data.decode("utf-8", "surrogatepass"))


def chunks(data: bytes, size: int = FRAME) -> Iterator[bytes]:
    """``data`` in parts of at most ``size`` bytes that end between code points."""
    at = 0
    while at < len(data):
        end = min(at + size, len(data))
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        yield data[at:end]
        at = end


def compressed(data: bytes, size: int = FRAME) -> tuple[int, int, list[dict]]:
    """(units, code points, frames) of a text."""
    packer = zstandard.ZstdCompressor(level=LEVEL)
    units = chars = 0
    inside, frames = False, []
    for part in chunks(data, size):
        frames.append({"units": units, "chars": chars, "open": inside, "data": packer.compress(part)})
        units += len(part.split()) + (inside and part[0] in _SPACES)
        inside = part[-1] not in _SPACES
        units -= inside  # counted in the frame in which it ends
        chars += code_points(part)
    return units + bool(data), chars, frames


class Seekable:
    """A stored text: what lies between two numbers of units, without the rest."""

    def __init__(self, units: int, chars: int, frames: list[dict]):
        self.units, self.chars, self.frames = units, chars, frames
        self._before = [f["units"] for f in frames]
        self._unpack = zstandard.ZstdDecompressor().decompress
        self._pack = zstandard.ZstdCompressor(level=LEVEL).compress

    def find(self, unit: int) -> tuple[int, int, int]:
        """(frame, byte in it, code points before) of the end of a number of units."""
        if unit == 0:
            return 0, 0, 0
        if unit == self.units:
            return len(self.frames), 0, self.chars
        number = bisect_left(self._before, unit) - 1
        frame = self.frames[number]
        part = self._unpack(frame["data"])
        wanted = unit - frame["units"]
        if frame["open"] and part[0] in _SPACES:
            wanted -= 1  # the word that ended with the frame before
        at = 0
        for _, word in zip(range(wanted), _WORD.finditer(part), strict=False):
            at = word.end()
        return number, at, frame["chars"] + code_points(part[:at])

    def between(self, start: tuple[int, int, int], end: tuple[int, int, int]) -> list[bytes]:
        """Frames of the text from one place to another; whole ones are taken as they are."""
        (first, low, _), (last, high, _) = start, end
        if first == last:
            return [] if low == high else [self._part(first, low, high)]
        out = [self.frames[first]["data"] if low == 0 else self._part(first, low, None)]
        out += [f["data"] for f in self.frames[first + 1 : last]]
        return out + ([self._part(last, 0, high)] if high else [])

    def _part(self, number: int, low: int, high: int | None) -> bytes:
        return self._pack(self._unpack(self.frames[number]["data"])[low:high])


_MARKS = {m: zstandard.ZstdCompressor(level=LEVEL).compress(m) for m in (PREFIX, SUFFIX, MIDDLE)}


def rearranged(text: Seekable, form: str, cuts: tuple[int, int]) -> tuple[int, int, list[bytes]]:
    """(code points of the prefix, of the middle, frames of the output) of psm or spm."""
    start, end = (0, 0, 0), (len(text.frames), 0, text.chars)
    low, high = (text.find(c) for c in cuts)
    prefix, middle, suffix = (
        text.between(a, b) for a, b in ((start, low), (low, high), (high, end))
    )
    first, second = [_MARKS[PREFIX], *prefix], [_MARKS[SUFFIX], *suffix]
    if form == "spm":
        first, second = second, first
    return low[2], high[2] - low[2], [*first, *second, _MARKS[MIDDLE], *middle]


def streamed(frames: list[bytes]) -> Iterator[bytes]:
    unpack = zstandard.ZstdDecompressor().decompress
    return map(unpack, frames)


def restored(frames: list[bytes], form: str) -> Iterator[bytes]:
    """The text that an output was made of, part by part, from the output and its form."""
    if form == "plain":
        yield from streamed(frames)
        return
    first, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    marks = _places(frames, [first, second, MIDDLE])
    ends = [*marks[1:], None]
    spans = {
        mark: (place + len(mark), end)
        for mark, place, end in zip((first, second, MIDDLE), marks, ends, strict=True)
    }
    for mark in (PREFIX, MIDDLE, SUFFIX):
        yield from _span(frames, *spans[mark])


def _places(frames: list[bytes], marks: list[bytes]) -> list[int]:
    """Byte at which each mark stands first, in their order."""
    found: list[int] = []
    kept, at = b"", 0
    for part in streamed(frames):
        window = kept + part
        base, low = at - len(kept), 0
        while len(found) < len(marks) and (place := window.find(marks[len(found)], low)) >= 0:
            found.append(base + place)
            low = place + len(marks[0])
        kept, at = window[max(low, len(window) - len(marks[0]) + 1) :], at + len(part)
    if len(found) < len(marks):
        raise ValueError("an output without all its marks")
    return found


def _span(frames: list[bytes], low: int, high: int | None) -> Iterator[bytes]:
    """Bytes ``low`` to ``high`` of the output; frames outside are passed by their sizes."""
    unpack, at = zstandard.ZstdDecompressor().decompress, 0
    for frame in frames:
        size = zstandard.frame_content_size(frame)
        if at + size > low and (high is None or at < high):
            part = unpack(frame)
            yield part[max(low - at, 0) : None if high is None else max(high - at, 0)]
        at += size


def _digest(parts: Iterator[bytes]) -> str:
    out = hashlib.sha256()
    for part in parts:
        out.update(part)
    return out.hexdigest()


def _sized(batches: Iterator[pa.RecordBatch], sizes) -> Iterator[pa.RecordBatch]:
    """Batches cut so that ``sizes(batch)`` per row adds up to a bounded number of bytes."""
    for batch in batches:
        first = total = 0
        for i, size in enumerate(sizes(batch)):
            if total + size > _ROWS_BYTES and i > first:
                yield batch.slice(first, i - first)
                first, total = i, 0
            total += size
        if batch.num_rows > first:
            yield batch.slice(first)


def store_frames(
    docs: DataFrame, key: str = "doc_id", text: str = "text", frame: int = FRAME
) -> DataFrame:
    """(key, units, chars, marked, frames): every text as seekable frames.

    ``marked`` tells that a text holds a mark of the rearranged form.
    """

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sized(batches, lambda b: pc.binary_length(b.column(1)).to_pylist()):
            rows = []
            for data in batch.column(1).cast(pa.binary()).to_pylist():
                marked = any(m in data for m in (PREFIX, SUFFIX, MIDDLE))
                units, chars, frames = compressed(data, frame)
                rows.append((units, chars, marked, frames))
            units, chars, marked, frames = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(units, pa.int64()),
                    pa.array(chars, pa.int64()),
                    pa.array(marked, pa.bool_()),
                    pa.array(frames, _STORED),
                ],
                names=["key", "units", "chars", "marked", "frames"],
            )

    kind = docs.schema[key].dataType.simpleString()
    source = docs.select(F.col(key).alias("key"), text_of(text).alias("text"))
    return source.mapInArrow(
        packed,
        f"key {kind}, units bigint, chars bigint, marked boolean, frames {STORED_TYPE}",
    ).withColumnRenamed("key", key)


def draws(key: Column, seed: int = SEED) -> list[Column]:
    """Four numbers drawn from the id, as the unsigned 8-digit groups of a digest."""
    name = F.coalesce(key.cast("string"), F.lit("null"))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), name), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)]


def fill_in_middle(
    frames: DataFrame,
    key: str = "doc_id",
    seed: int = SEED,
    fim_percent: int = FIM_PERCENT,
    spm_percent: int = SPM_PERCENT,
) -> DataFrame:
    """(key, n, form, prefix_chars, middle_chars, output) for every stored text.

    ``output`` is the rearranged text as an array of frames; their concatenation is a valid
    compressed file.
    """
    h1, h2, h3, h4 = draws(F.col(key), seed)
    parts = F.col("units") + 1
    plain = (F.col("units") == 0) | F.col("marked") | (h3 % 100 >= fim_percent)
    form = F.when(plain, "plain").when(h4 % 100 < spm_percent, "spm").otherwise("psm")
    placed = frames.select(
        F.col(key).alias("key"),
        F.col("units").alias("n"),
        form.alias("form"),
        F.least(h1 % parts, h2 % parts).alias("low"),
        F.greatest(h1 % parts, h2 % parts).alias("high"),
        "chars",
        "frames",
    )

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sized(batches, lambda b: _nested_sizes(b.column(6))):
            rows = []
            columns = [c.to_pylist() for c in batch.columns[1:]]
            for units, kind, low, high, chars, held in zip(*columns, strict=True):
                if kind == "plain":
                    rows.append((None, None, [f["data"] for f in held]))
                else:
                    rows.append(rearranged(Seekable(units, chars, held), kind, (low, high)))
            prefix, middle, output = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    pa.array(prefix, pa.int64()),
                    pa.array(middle, pa.int64()),
                    pa.array(output, _OUTPUT),
                ],
                names=["key", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    kind = frames.schema[key].dataType.simpleString()
    return placed.mapInArrow(
        made,
        f"key {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint,"
        " output array<binary>",
    ).withColumnRenamed("key", key)


def _nested_sizes(column: pa.Array) -> list[int]:
    """A bound on the decompressed bytes of each row's frames."""
    return [FRAME * (n or 0) // 16 for n in column.value_lengths().to_pylist()]


def with_digests(made: DataFrame) -> DataFrame:
    """``made`` with output_sha256 and restored_sha256, streamed from the output's frames."""

    def digested(form: pa.Array, output: pa.Array) -> pa.Array:
        rows = []
        for kind, frames in zip(form.to_pylist(), output.to_pylist(), strict=True):
            out = _digest(streamed(frames))
            back = out if kind == "plain" else _digest(restored(frames, kind))
            rows.append({"output_sha256": out, "restored_sha256": back})
        return pa.array(
            rows, pa.struct([("output_sha256", pa.string()), ("restored_sha256", pa.string())])
        )

    digest = F.arrow_udf(digested, "struct<output_sha256: string, restored_sha256: string>")
    return made.withColumn("_digests", digest.asNondeterministic()("form", "output")).select(
        *made.columns, "_digests.output_sha256", "_digests.restored_sha256"
    )
