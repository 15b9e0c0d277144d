"""Byte-level BPE encoding and decoding by a sentencepiece model written from a rank file.

A rank file lists byte strings with their merge ranks. Each becomes a piece of a
sentencepiece BPE model: its bytes mapped one to one to letters, its score the
negative rank, so the best-scored merge is the lowest-ranked one. Piece ids equal
ranks. The normaliser is the identity and nothing is added to a text. The model
file is written out here field by field; nothing is trained.

Texts are cut into pre-tokens by a pattern, each encoded on its own. Decoding maps
ids to pieces and the letters back to bytes.
"""

from __future__ import annotations

import base64
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import replacing

#: First of the 256 letters that stand for bytes.
FIRST_LETTER = 0x100

#: Pre-tokens a worker remembers (about 100 MB); then it starts again.
REMEMBERED = 1 << 19

# Field numbers and enumerations of the sentencepiece model format.
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
_PIECE, _SCORE, _TYPE, _NORMAL, _UNKNOWN = 1, 2, 3, 1, 2
_MODEL_TYPE, _BPE, _VOCAB_SIZE = 3, 2, 4
_UNK_ID, _BOS_ID, _EOS_ID, _PAD_ID = 40, 41, 42, 43
_NAME, _DUMMY_PREFIX, _EXTRA_SPACES, _ESCAPE_SPACES = 1, 3, 4, 5


def read_ranks(path: str) -> list[bytes]:
    """Byte strings of a rank file by rank: lines of base64 bytes and a rank from 0 on."""
    ranks = {}
    with open(path, "rb") as lines:
        for line in lines:
            if line.strip():
                token, rank = line.split()
                ranks[int(rank)] = base64.b64decode(token)
    tokens = [ranks[i] for i in range(len(ranks))]
    if missing := {bytes([b]) for b in range(256)} - set(tokens):
        raise ValueError(f"{len(missing)} single bytes have no rank")
    return tokens


def to_letters(data: bytes) -> str:
    return data.decode("latin-1").translate(_LETTERS)


def to_bytes(letters: str) -> bytes:
    return bytes(ord(c) - FIRST_LETTER for c in letters)


_LETTERS = {b: FIRST_LETTER + b for b in range(256)}


def _varint(value: int) -> bytes:
    value &= (1 << 64) - 1  # negative numbers as their 64-bit complement
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    out.append(value)
    return bytes(out)


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _string(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def _float(field: int, value: float) -> bytes:
    return _varint(field << 3 | 5) + struct.pack("<f", value)


def serialised_model(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model whose piece ids are the ranks; the unknown piece comes last."""
    pieces = [
        _string(_PIECES, _string(_PIECE, to_letters(t).encode()) + _float(_SCORE, -float(rank))
                + _number(_TYPE, _NORMAL))
        for rank, t in enumerate(tokens)
    ]
    # No text maps to the letter of the unknown piece.
    unknown = chr(FIRST_LETTER + 256).encode()
    pieces.append(
        _string(_PIECES, _string(_PIECE, unknown) + _float(_SCORE, 0.0) + _number(_TYPE, _UNKNOWN))
    )
    trainer = _number(_MODEL_TYPE, _BPE) + _number(_VOCAB_SIZE, len(pieces))
    trainer += _number(_UNK_ID, len(tokens))
    trainer += b"".join(_number(field, -1) for field in (_BOS_ID, _EOS_ID, _PAD_ID))
    normalizer = _string(_NAME, b"identity") + b"".join(
        _number(field, 0) for field in (_DUMMY_PREFIX, _EXTRA_SPACES, _ESCAPE_SPACES)
    )
    return b"".join(pieces) + _string(_TRAINER, trainer) + _string(_NORMALIZER, normalizer)


class Encoder:
    """Encodes texts with a serialised model; remembers the pre-tokens it met.

    Ids are kept as the bytes of an int32 array.
    """

    def __init__(self, model: bytes, pattern: str) -> None:
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = range(self.pieces.unk_id())
        self.whole = dict(zip(map(self.pieces.id_to_piece, ids), ids))
        self.split = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}

    def ids(self, text: str) -> bytes:
        found = self.split(text)
        new = set(found).difference(self.known)
        if new:
            if len(self.known) + len(new) > REMEMBERED:
                self.known = {}
                new = set(found)
            self._learn(new)
        ids = b"".join(map(self.known.__getitem__, found))
        for piece in new:
            if len(piece) > 256:  # rare, and large to remember
                del self.known[piece]
        return ids

    def _learn(self, new: set[str]) -> None:
        parted, letters = [], []
        for piece in new:
            mapped = to_letters(piece.encode("utf-8", "surrogatepass"))
            # A pre-token that is a token itself is that token, whatever its merges.
            rank = self.whole.get(mapped)
            if rank is None:
                parted.append(piece)
                letters.append(mapped)
            else:
                self.known[piece] = np.int32(rank).tobytes()
        for piece, ids in zip(parted, self.pieces.encode(letters, num_threads=1)):
            self.known[piece] = array("i", ids).tobytes()


def _encode_udf(model: bytes, pattern: str):
    @F.arrow_udf("array<int>")
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(model, pattern)
        for batch in batches:
            rows = [encoder.ids(t.as_py() or "") for t in batch]
            offsets = np.cumsum([0, *map(len, rows)]) // 4
            values = pa.array(np.frombuffer(b"".join(rows), np.int32))
            yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)

    return compute.asNondeterministic()


def _decode_udf(model: bytes):
    @F.arrow_udf("binary")
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        table = [to_bytes(pieces.id_to_piece(i)) for i in range(pieces.unk_id())]
        for batch in batches:
            ids = batch.values.to_numpy()
            ends = batch.offsets.to_numpy().tolist()
            found = [
                b"".join(map(table.__getitem__, ids[a:b].tolist()))
                for a, b in zip(ends, ends[1:])
            ]
            yield pa.array(found, pa.binary(), mask=batch.is_null().to_numpy(zero_copy_only=False))

    return compute.asNondeterministic()


def encode(
    docs: DataFrame, model: bytes, pattern: str, text_col: str = "text", ids_col: str = "ids"
) -> DataFrame:
    """``docs`` with the token ids of each whole text in ``ids_col``.

    ``model`` comes from ``serialised_model``; its size is that of the vocabulary.
    Every match of ``pattern`` is encoded separately; strings of special tokens
    are ordinary text. Null and empty texts have an empty array. Rows stay as they
    are, repeated or not; a column that has the name of the output is replaced.
    """
    return replacing(docs, ids_col).withColumn(ids_col, _encode_udf(model, pattern)(F.col(text_col)))


def decode(
    encoded: DataFrame, model: bytes, ids_col: str = "ids", bytes_col: str = "decoded"
) -> DataFrame:
    """``encoded`` with the bytes of each array of ids in ``bytes_col``.

    An empty array gives no bytes and null gives null. An id that is not in the
    vocabulary ends the job: the ids belong to another model.
    """
    return replacing(encoded, bytes_col).withColumn(bytes_col, _decode_udf(model)(F.col(ids_col)))
