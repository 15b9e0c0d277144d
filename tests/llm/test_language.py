import random
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendlens.llm import checks, language
from spendlens.llm.common import held_out, mixed
from tests.conftest import SMALL

TABLE = language.alphabet()
SOUNDS = {"aa": "ka ta mo shi ru en", "bb": "str ung ich aus zw ver", "cc": "eau oui cho ment é ai"}


def talk(rng, name, n):
    sounds = SOUNDS[name].split()
    return " ".join("".join(rng.choice(sounds) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def naive_grams(text):
    """N-grams of the text written out, by characters alone."""
    kept = []
    for c in text:
        kind = unicodedata.category(c)[0]
        kept.append(c.lower() if kind == "L" and len(c.lower()) == 1 else c if kind in "LM" else " ")
    whole = f" {' '.join(''.join(kept).split(' '))} "
    while "  " in whole:
        whole = whole.replace("  ", " ")
    if whole == " ":
        return []
    return [g for n in language.LENGTHS for i in range(len(whole) - n + 1)
            if (g := whole[i : i + n]).strip(" ") and " " not in g[1:-1]]


def naive_bucket(gram):
    h = 0
    for c in gram:
        flag = language._MARK if unicodedata.category(c)[0] == "M" else 0
        h = (h * 0x9E3779B97F4A7C15 + (ord(c) | flag)) % 2**64
    spot = mixed(np.array([h ^ len(gram)], np.uint64))[0]
    return int(spot >> np.uint64(65 - language.BUCKETS.bit_length()))


TEXTS = ["", "   ", "?! 12", "a", "Ab", "x y", "Words, in a row: éÀ ß", "퟿ हिन्दी में", "İstanbul ΣΑΣ", "🙂 a🙂b", "é", "́",
         "tail  ", "  head", "one-two—three·four", "\U00020000 \U0001d400x", "a" * 30, "a " * 30]


@pytest.fixture(scope="module")
def model():
    rng = random.Random(1)
    samples = [(name, [talk(rng, name, 12) for _ in range(3)]) for name in SOUNDS for _ in range(40)]
    df = language.document_counts(TABLE, (p for _, ps in samples for p in ps))
    return language.train(samples, *df)


@pytest.mark.parametrize("part", [1, 3, 7, 1 << 16])
def test_grams_and_counts_against_brute_force(monkeypatch, part):
    monkeypatch.setattr(language, "_PART", part)
    want = [Counter(map(naive_bucket, naive_grams(t))) for t in TEXTS]
    got = [Counter() for _ in TEXTS]
    for owner, parts, again in language.batched(TEXTS, TABLE):
        found = language.buckets(parts, again)
        ends = np.cumsum([len(p) for p in parts])
        for number, a, b in zip(owner, [0, *ends], ends):
            got[number].update(x for x in found[:, a:b].ravel().tolist() if x < language.BUCKETS)
    assert got == want
    n, df = language.document_counts(TABLE, TEXTS)
    assert n == len(TEXTS)
    assert {i: int(df[i]) for i in np.flatnonzero(df)} == Counter(b for c in want for b in c)


@pytest.mark.parametrize("part", [2, 1 << 16])
def test_scores_against_brute_force(monkeypatch, model, part):
    monkeypatch.setattr(language, "_PART", part)
    rng = random.Random(2)
    texts = TEXTS + [talk(rng, name, n) for name in SOUNDS for n in (1, 5, 200)]
    names, scores = model.predict(texts)
    for text, name, score in zip(texts, names, scores):
        grams = naive_grams(text)
        if not any(unicodedata.category(c)[0] == "L" for c in text):
            assert (name, score) == ("und", 0)
            continue
        logits = model.bias + sum(model.weights[naive_bucket(g)].astype(float) for g in grams) / len(grams)
        p = np.exp(logits / model.temperature)
        assert name == model.languages[int(logits.argmax())]
        assert score == pytest.approx(p.max() / p.sum())


def test_weights_are_sparse_and_sure_of_long_texts(model):
    assert 0 < (model.weights != 0).any(axis=1).sum() < 3000
    rng = random.Random(3)
    for name in SOUNDS:
        names, scores = model.predict([talk(rng, name, 300), talk(rng, name, 300) + " 123 !!!"])
        assert names == [name, name] and min(scores) > 0.9


def test_temperature_lowers_the_loss():
    rng = np.random.default_rng(4)
    y = rng.integers(0, 3, 500)
    truth = np.eye(3)[y] * 1.5 + rng.normal(size=(500, 3))
    best = language.calibrated(truth * 10, y)
    losses = [language._log_loss(truth * 10, y, t) for t in (best / 2, best * 0.9, best, best * 1.1, best * 2)]
    assert min(losses) == losses[2] and best > 3


def test_learns_from_rows_that_are_not_held_out_only(spark, docs):
    rng = random.Random(5)
    names = list(SOUNDS)
    rows = docs(*[(i, talk(rng, names[i % 3], 20)) for i in range(120)])
    told = F.when(F.col("doc_id") % 7 == 0, None).otherwise(F.element_at(F.lit(names), (F.col("doc_id") % 3 + 1).cast("int")))
    # Held-out rows say something else, which must leave no trace.
    told = F.when(held_out(), "zz").otherwise(told)
    known = rows.withColumn("lang", told)
    learnable = language._learnable(known, "doc_id", "text", "lang")
    want = {str(i) for i in range(120) if zlib.crc32(str(i).encode()) % 3 != 1 and i % 7}
    assert {r.id for r in learnable.collect()} == want
    made = language.learn(known)
    assert made.languages == names
    out = language.with_language(rows, made).collect()
    assert all(r.lang_pred == names[r.doc_id % 3] for r in out)
    texts = [r.text for r in learnable.collect()]
    n, df = language.count_documents(learnable)
    assert n == len(texts) and (df == language.document_counts(TABLE, texts)[1]).all()


def test_sample_is_bounded_and_even(spark, docs):
    rows = docs(*[(i, f"text {i} " * 200) for i in range(300)])
    lang = F.when(F.col("doc_id") < 250, "big").when(F.col("doc_id") < 299, "small").otherwise("one")
    found = language.sample(language._learnable(rows.withColumn("lang", lang), "doc_id", "text", "lang"), 30)
    assert Counter(name for name, _ in found)["big"] == 10
    assert all(len(p) <= language.PASSAGE_CHARS and 0 < len(ps) <= language.PASSAGES for _, ps in found for p in ps)
    assert any(not p.startswith("text") for _, ps in found for p in ps)


def test_hostile_rows(spark, docs, model):
    long = "ka ta mo " * 200_000
    rows = docs((1, None), (1, None), (None, ""), (2, long), (2, long), (3, "x" * 300_000), (4, "́ ?")).withColumn("Lang_Pred", F.lit(1))
    out = language.with_language(rows, model)
    assert out.columns == [c for c in rows.columns if c not in ("Score", "Lang_Pred")] + ["lang_pred", "score"]
    got = {(r.doc_id, r.lang_pred) for r in out.collect()}
    assert {(1, "und"), (None, "und"), (4, "und"), (2, "aa")} <= got and out.count() == 7
    assert language.with_language(rows.where("false"), model).count() == 0


def test_one_language_or_none(spark, docs):
    rows = docs((1, "a b"), (2, "c d"), (3, "e"), (4, None))
    none = language.learn(rows.withColumn("lang", F.lit(None).cast("string")))
    assert {(r.lang_pred, r.score) for r in language.with_language(rows, none).collect()} == {("und", 0.0)}
    one = language.learn(rows)
    assert {(r.lang_pred, r.score) for r in language.with_language(rows, one).collect()} == {("en", 1.0), ("und", 0.0)}


def test_held_out_accuracy(spark):
    folder = SMALL.replace("sf0.001", "sf0.01")
    found = checks.QUERIES["op11_language_id"](spark, folder).where("held_out")
    met = found.join(checks.table(spark, folder, "documents").select("doc_id", "lang"), "doc_id").collect()
    assert len(met) > 300 and sum(r.lang == r.lang_pred for r in met) / len(met) >= 0.99
