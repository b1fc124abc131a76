"""Hashes of words over blocks of texts, in numpy: what several operators count or compare.

A word's hash is a polynomial of its bytes, mixed; equal words have equal hashes wherever
they stand. Two bases give two independent hashes, for those who need 128 bits.
"""

from collections.abc import Iterator

import numpy as np

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
SPACES = b" \t\n\x0b\x0c\r"
BLOCK_BYTES = 1 << 21

_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers under which near numbers have nothing in common."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def salts(count: int, seed: int) -> np.ndarray:
    """``count`` fixed 64-bit numbers."""
    return mixed(np.arange(1, count + 1, dtype=np.uint64) * _BASES[0] + np.uint64(seed))


def members(of: bytes) -> np.ndarray:
    """Per byte value, whether it is one of ``of``."""
    table = np.zeros(256, bool)
    table[np.frombuffer(of, np.uint8)] = True
    return table


def blocks(texts: list[bytes], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` of about ``limit`` bytes; a longer text is a range of its own."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if i > first and size + len(text) > limit:
            yield first, i
            first, size = i, 0
        size += len(text)
    if first < len(texts):
        yield first, len(texts)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, A-Z in lower case, a line break after each; where each starts."""
    data = np.frombuffer((b"\n".join(texts) + b"\n").translate(LOWER), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    return data, np.cumsum(sizes) - sizes


def words(
    data: np.ndarray, outside: np.ndarray, hashes: int = 1
) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(starts, ends, hashes) of the runs of bytes that are not marked in ``outside``."""
    inside = np.flatnonzero(~outside[data])
    if not len(inside):
        none = np.zeros(0, np.int64)
        return none, none, [np.zeros(0, np.uint64)] * hashes
    first = np.concatenate(([0], np.flatnonzero(np.diff(inside) > 1) + 1))
    sizes = np.diff(np.append(first, len(inside)))
    place = np.arange(len(inside)) - np.repeat(first, sizes)
    letters = data[inside].astype(np.uint64) + np.uint64(1)
    found = []
    for base in _BASES[:hashes]:
        powers = np.full(int(sizes.max()), base, np.uint64)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
        found.append(mixed(np.add.reduceat(letters * powers[place], first)))
    starts = inside[first]
    return starts, starts + sizes, found
