"""Token counts of texts of any length, by overlap resynchronisation.

A text longer than a chunk is encoded in overlapping chunks with character
offsets. Where a chunk begins it may cut a word, so its first tokens can be wrong;
further on both chunks agree. They are spliced at a stable common boundary: a
place in the overlap where both have a token that starts right after ASCII white
space, and the tokens from the common boundary before it are the same in both.

Such a place is safe for tokenizers that never let a token span white space: white
space is part of no special string, composes with no character next to it, and
the pattern that parts words drops it, so the tokens on either side do not depend
on the other side. Where an overlap holds no two such places it is widened, and
past the chunk's own beginning the chunk is made longer: text without white space
ends up in one piece, as the tokenizer itself would have it.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from spendlens.llm.common import replacing

#: Characters of a chunk and of the first overlap tried.
CHUNK = 1 << 15
OVERLAP = 1 << 9

#: Words a worker remembers (about 80 MB); then it starts again.
REMEMBERED = 1 << 19

# ASCII white space.
_BLANKS = frozenset(" \t\n\v\f\r")


class ChunkedEncoder:
    """Encodes long texts chunk by chunk; memory follows the chunk, not the text."""

    def __init__(self, tokenizer: Tokenizer, chunk: int = CHUNK, overlap: int = OVERLAP) -> None:
        self.tokenizer, self.chunk, self.overlap = tokenizer, chunk, overlap

    def _encode(self, text: str, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a part of the text and where in the text each starts."""
        found = self.tokenizer.encode(text[begin:end], add_special_tokens=False)
        starts = np.fromiter((a for a, _ in found.offsets), np.int64, len(found.ids))
        return np.array(found.ids, np.int64), starts + begin

    def pieces(self, text: str) -> Iterator[np.ndarray]:
        """Ids of the text in order, one array per splice."""
        size, begin, accepted = len(text), 0, 0
        end = min(size, self.chunk)
        ids, starts = self._encode(text, begin, end)
        width = self.overlap
        while end < size:
            if end - width <= accepted:
                # No boundary since the last splice: this chunk must reach further.
                end = min(size, end + 2 * width)
                ids, starts = self._encode(text, begin, end)
                continue
            next_begin = end - width
            next_end = min(size, next_begin + max(self.chunk, 2 * width))
            next_ids, next_starts = self._encode(text, next_begin, next_end)
            at = splice(text, ids, starts, next_ids, next_starts, max(accepted, next_begin), end)
            if at is None:
                width *= 2
                continue
            yield ids[np.searchsorted(starts, accepted) : np.searchsorted(starts, at)]
            begin, end, accepted = next_begin, next_end, at
            ids, starts, width = next_ids, next_starts, self.overlap
        yield ids[np.searchsorted(starts, accepted) :]

    def count(self, text: str) -> int:
        return sum(map(len, self.pieces(text)))


class WordCounts:
    """Counts the tokens of texts that need no chunks.

    ASCII white space is a stable boundary everywhere, so a text has the tokens of
    its words. Each word is encoded once and its count remembered.
    """

    def __init__(self, tokenizer: Tokenizer) -> None:
        self.tokenizer = tokenizer
        self.known: dict[bytes, int] = {}

    def count(self, text: bytes) -> int:
        words = text.split()  # of bytes: at ASCII white space alone
        new = set(words).difference(self.known)
        if new:
            if len(self.known) + len(new) > REMEMBERED:
                self.known = {}
                new = set(words)
            ordered = list(new)
            found = self.tokenizer.encode_batch_fast(
                [w.decode("utf-8", "replace") for w in ordered], add_special_tokens=False
            )
            self.known.update(zip(ordered, map(len, found)))
        return sum(map(self.known.__getitem__, words))


def splice(text, ids, starts, next_ids, next_starts, begin: int, end: int) -> int | None:
    """The last stable common boundary of two encodings between two places, or None."""
    common = np.intersect1d(starts, next_starts)
    places = [
        p for p in common[(common > begin) & (common < end)].tolist() if text[p - 1] in _BLANKS
    ]
    for before, at in zip(places[-2::-1], places[:0:-1]):
        mine = ids[np.searchsorted(starts, before) : np.searchsorted(starts, at)]
        other = next_ids[np.searchsorted(next_starts, before) : np.searchsorted(next_starts, at)]
        if np.array_equal(mine, other):
            return at
    return None


def words_apart(tokenizer: Tokenizer) -> bool:
    """Whether texts have just the tokens of their words: blanks add no token and are in none."""

    def ids(text: str) -> list[int]:
        return tokenizer.encode(text, add_special_tokens=False).ids

    if any(not _BLANKS.isdisjoint(token) for token in tokenizer.get_vocab(with_added_tokens=True)):
        return False
    blanks = sorted(_BLANKS)
    gaps = blanks + [a + b for a in blanks for b in blanks]
    words = ["a", "1", ".", "\u00e9"]
    alone = {word: ids(word) for word in words}
    return all(not ids(gap) for gap in gaps) and all(
        ids(f"{gap}{a}{gap}{b}{gap}") == alone[a] + alone[b] for gap in gaps for a in words for b in words
    )


def counter(tokenizer: Tokenizer, chunk: int, overlap: int) -> Callable[[str], int]:
    """Counts the tokens of one text; texts are encoded whole unless their words stand apart."""
    if not words_apart(tokenizer):
        return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)
    long = ChunkedEncoder(tokenizer, chunk, overlap)
    short = WordCounts(tokenizer)
    return lambda text: long.count(text) if len(text) > chunk else short.count(text.encode())


def _count_udf(model: str, chunk: int, overlap: int):
    @F.arrow_udf("bigint")
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        tokenizer = Tokenizer.from_str(model)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        count = counter(tokenizer, chunk, overlap)
        for batch in batches:
            yield pa.array([count(value.as_py() or "") for value in batch], pa.int64())

    return compute.asNondeterministic()


def count_tokens(
    docs: DataFrame,
    model: str,
    limit: int = 2048,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` of each whole text.

    ``model`` is the text of a tokenizer's JSON file. Where its tokens hold white space,
    each text is encoded whole, however long. Nothing is added, cut or padded; strings of special tokens count as the
    tokenizer takes them by default. Null and empty texts have no tokens. Rows
    stay as they are, repeated or not; columns with an output's name are replaced.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    counted = replacing(docs, "n_bytes", "n_tokens", "over_limit").withColumn(
        "n_tokens", _count_udf(model, chunk, overlap)(F.col(text_col))
    )
    return counted.withColumn("n_bytes", F.octet_length(text).cast("bigint")).withColumn(
        "over_limit", F.col("n_tokens") > limit
    )
