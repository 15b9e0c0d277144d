import base64
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from spendlens.llm import bpe, checks
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def library():
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def model():
    return checks.byte_bpe_model()


def ids(encoder, text):
    return np.frombuffer(encoder.ids(text), np.int32).tolist()


def test_encodes_like_the_library(library, model):
    rng = random.Random(1)
    letters = [chr(c) for c in (*range(0x250), *range(0x2000, 0x2070), 0x1F600, 0x301, 0xFFFD, 0x10FFFF)]
    letters += ["<|endoftext|>", "'s", "  ", "\n\n", "x" * 300]
    encoder = bpe.Encoder(model, P.PATTERN)
    for _ in range(4000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(12)))
        assert ids(encoder, text) == library.encode_ordinary(text), repr(text)


def test_forgets_and_goes_on(library, model, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 4)
    encoder = bpe.Encoder(model, P.PATTERN)
    for text in ("one two three four five six", "one seven eight", "nine one two"):
        assert ids(encoder, text) == library.encode_ordinary(text)


def test_query_matches_the_library(spark, library):
    import hashlib

    def sha(data):
        return hashlib.sha256(data).hexdigest()

    table = {r.doc_id: r.text for r in checks.table(spark, SMALL, "documents").collect()}
    for r in checks.QUERIES["op1_byte_bpe"](spark, SMALL).collect():
        found = library.encode_ordinary(table[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(found), sha(" ".join(map(str, found)).encode()))
        assert r.decoded_sha256 == sha(table[r.doc_id].encode())


def test_hostile_rows(docs, model):
    rows = docs((1, None), (1, None), (None, ""), (2, "ab" * 100_000), (3, "été \U0001F600\x00"))
    out = bpe.decode(bpe.encode(rows, model, P.PATTERN, ids_col="h"), model, ids_col="h")
    got = sorted((r.text or "", bytes(r.decoded), len(r.h)) for r in out.collect())
    assert [(t.encode(), len(t) > 0) for t, _, _ in got] == [(d, n > 0) for _, d, n in got]
    assert bpe.encode(rows.where("false"), model, P.PATTERN).count() == 0


def test_null_ids_decode_to_null(spark, model):
    rows = spark.createDataFrame([(None,), ([],), ([0, 1],)], "ids array<int>")
    assert [r.decoded is None for r in bpe.decode(rows, model).collect()] == [True, False, False]
