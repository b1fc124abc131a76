"""Byte-level BPE ids of whole texts."""

import base64
from array import array

import public_tokenizers
import tiktoken


class BpeIds:
    """Ids as little-endian unsigned 32-bit numbers.

    The file lists the vocabulary of byte_bpe_50k.json as ranks, so the ids are the same;
    the string of a special token inside a text is ordinary text.
    """

    def __init__(self, path: str | None = None):
        path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        bpe = tiktoken.Encoding(
            "bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self._encode = bpe.encode_ordinary

    def ids(self, text: str) -> bytes:
        return array("I", self._encode(text)).tobytes()
