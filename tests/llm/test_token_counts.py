import random

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from spendlens.llm import checks, token_counts
from tests.conftest import SMALL

PARTS = [*"abcDE'st  \n\t12é.,!", "<|endoftext|>", "́", "Å", "中", "\U0001F600", "don't", "\x1c", "\x85", " "]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(P.path("word_bpe_49k.json"))


@pytest.mark.parametrize("blanks", [True, False])
def test_splices_give_the_tokens_of_the_whole(library, blanks):
    rng = random.Random(3)
    for _ in range(400):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randrange(400)))
        text = text if blanks else "".join(text.split())
        encoder = token_counts.ChunkedEncoder(library, rng.choice([16, 40, 64]), rng.choice([4, 8, 16]))
        got = np.concatenate(list(encoder.pieces(text))).tolist()
        assert got == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_overlaps_are_widened(library, monkeypatch):
    tried = []
    whole = token_counts.splice
    monkeypatch.setattr(token_counts, "splice", lambda *a: tried.append(found := whole(*a)) or found)
    text = "word " * 30 + "x" * 100 + " and more words here" * 20
    encoder = token_counts.ChunkedEncoder(library, 64, 4)
    assert encoder.count(text) == len(library.encode(text, add_special_tokens=False).ids)
    assert None in tried and any(p is not None for p in tried)


def test_remembered_words_give_the_tokens_of_the_whole(library, monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED", 50)
    rng = random.Random(6)
    counts = token_counts.WordCounts(library)
    for _ in range(600):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randrange(60)))
        assert counts.count(text.encode()) == len(library.encode(text, add_special_tokens=False).ids), repr(text)


@pytest.mark.parametrize("kind", ["bytes", "metaspace"])
def test_models_that_keep_blanks(library, kind):
    from tokenizers import models, pre_tokenizers

    letters = [*pre_tokenizers.ByteLevel.alphabet(), "\u2581"]
    other = Tokenizer(models.BPE({c: i for i, c in enumerate(sorted(letters))}, []))
    other.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False) if kind == "bytes" else pre_tokenizers.Metaspace()
    assert token_counts.words_apart(library) and not token_counts.words_apart(other)
    count = token_counts.counter(other, 16, 4)
    for text in ("a b", "a  b c ", "word " * 20, ""):
        assert count(text) == len(other.encode(text, add_special_tokens=False).ids)


def test_query_matches_the_library(spark, library):
    table = {r.doc_id: r.text for r in checks.table(spark, SMALL, "documents").collect()}
    for r in checks.QUERIES["op8_token_counts"](spark, SMALL).collect():
        n = len(library.encode(table[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(table[r.doc_id].encode()), n, n > 2048)


def test_hostile_rows(docs, library):
    long = "some words and more " * 20_000
    rows = docs((1, None), (1, None), (None, ""), (2, long), (3, "<|endoftext|>"))
    with open(P.path("word_bpe_49k.json"), encoding="utf-8") as file:
        model = file.read()
    got = token_counts.count_tokens(rows, model, chunk=5000, overlap=100).collect()
    assert sorted((r.n_bytes, r.n_tokens, r.over_limit) for r in got) == [
        (0, 0, False), (0, 0, False), (0, 0, False), (13, 1, False), (len(long), 80_000, True)]
    assert token_counts.count_tokens(rows.where("false"), model).count() == 0
