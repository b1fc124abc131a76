"""Token counts under a unigram vocabulary, without making the tokens.

A text is cut at blanks, every word gets the mark of a blank in front, and a word's best
segmentation is that of the greatest sum of piece scores. An Aho-Corasick automaton lists
every place where a piece of the vocabulary ends in a word; dynamic programming over these
places carries only the best score and how many pieces it takes.

Tie rules are those of the tokenizer: places are visited by where a piece starts, and a later
one replaces an earlier one of the same end only if its score is greater, so among equals
the piece that starts first, the longest, stays. A character that no piece covers costs ten
less than the lowest score; a run of such characters is one unknown token, or, where the
vocabulary has byte pieces, as many tokens as it has bytes.

Defined results: a null or empty text has no tokens. Rows are counted one by one; repeated
rows and null ids stay. Only the id and text columns are used.
"""

import math
from collections.abc import Iterator

import ahocorasick
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
UNKNOWN_PENALTY = 10.0
MEMO = 300_000


def unigram_vocabulary(path: str | None = None) -> tuple[list[tuple[str, float]], int, bool]:
    """(pieces with scores, number of the unknown piece, whether bytes are pieces).

    The public file orders its pieces by rank; the score of rank r is -log(r + 2), the log
    of a Zipf frequency up to a constant.
    """
    path = path or public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [(model.id_to_piece(i), -math.log(i + 2)) for i in range(model.get_piece_size())]
    return pieces, model.unk_id(), any(model.is_byte(i) for i in range(len(pieces)))


class TokenCounter:
    """Counts tokens of texts; words seen before are looked up."""

    def __init__(self, pieces: list[tuple[str, float]], unknown: int, byte_pieces: bool):
        self._unknown, self._bytes = unknown, byte_pieces
        self._floor = min(score for _, score in pieces) - UNKNOWN_PENALTY
        self._automaton = ahocorasick.Automaton()
        for number, (piece, score) in enumerate(pieces):
            if piece and number != unknown:
                self._automaton.add_word(piece, (len(piece), score))
        self._automaton.make_automaton()
        self._memo: dict[str, int] = {}

    def word(self, word: str) -> int:
        """Tokens of a word that starts with the mark.

        Places come by their end, the longest piece first, so the first of equal scores is
        the one that starts first.
        """
        size = len(word)
        best, count = [-math.inf] * (size + 1), [0] * (size + 1)
        best[0], done, single = 0.0, 0, False
        unknown = [False] * (size + 1)
        for last, (length, score) in self._automaton.iter(word):
            end = last + 1
            while done < last:
                self._close(word, done, single, best, count, unknown)
                done, single = done + 1, False
            total = best[end - length] + score
            if total > best[end]:
                best[end], count[end] = total, count[end - length] + 1
            if length == 1:
                single = True
        while done < size:
            self._close(word, done, single, best, count, unknown)
            done, single = done + 1, False
        return count[size]

    def _close(self, word, at, single, best, count, unknown) -> None:
        """Let the character at ``at`` be unknown, unless a piece is just that character."""
        total = best[at] + self._floor
        if single or total <= best[at + 1]:
            return
        if self._bytes:
            more = len(word[at].encode("utf-8", "surrogatepass"))
        else:
            more = 0 if unknown[at] else 1
        best[at + 1], count[at + 1], unknown[at + 1] = total, count[at] + more, True

    def text(self, text: str | None) -> int:
        if not text:
            return 0
        total, memo = 0, self._memo
        words = text.replace(" ", MARK).split(MARK)
        for word in words[1:] if words[0] == "" else words:
            found = memo.get(word)
            if found is None:
                if len(memo) >= MEMO:
                    memo.clear()
                found = memo[word] = self.word(MARK + word)
            total += found
        return total


def count_tokens(
    docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, n_chars, n_tokens) of every row; ``path`` names the vocabulary file."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter(*unigram_vocabulary(path))
        for batch in batches:
            counts = [counter.text(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(counts, pa.int64())],
                names=["key", "n_chars", "n_tokens"],
            )

    kind = docs.schema[key].dataType.simpleString()
    source = docs.select(
        F.col(key).alias("key"),
        F.coalesce(F.length(text), F.lit(0)).cast("bigint").alias("n_chars"),
        F.col(text).alias("text"),
    )
    out = source.mapInArrow(counted, f"key {kind}, n_chars bigint, n_tokens bigint")
    return out.withColumnRenamed("key", key)
