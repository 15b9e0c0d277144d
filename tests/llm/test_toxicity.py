import random
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendlens.llm import checks, toxicity
from spendlens.llm.common import mixed
from tests.conftest import SMALL

LABELS = "doc_id bigint, quality int, toxic int"


def talk(rng, bad):
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8))) for _ in range(rng.randrange(30, 200))]
    for word in bad:
        words.insert(rng.randrange(len(words)), word)
    return " ".join(words)


@pytest.fixture(scope="module")
def model():
    rng = random.Random(1)
    insults = ["stupido", "worthlesson", "moronic", "idiotes"]
    texts = [talk(rng, rng.sample(insults, 2) if i % 4 == 0 else []) for i in range(400)]
    return toxicity.train([toxicity.some_bags(t, 128) for t in texts], [int(i % 4 == 0) for i in range(400)])


def test_unseen_spellings_and_long_texts(model):
    rng = random.Random(2)
    for bad in (["stupidoo"], ["WORTHLESSON!"], ["moronicc", "xidiotes"], ["idiotess", "stupidus"]):
        assert model.score([talk(rng, bad)])[0] >= 0.7
    clean = talk(rng, [])
    assert model.score([clean])[0] < 0.7
    assert model.score([" ".join([clean] * 50 + ["moronic stupido"] + [clean] * 50)])[0] >= 0.7


def test_scores_do_not_depend_on_the_batch(model):
    rng = random.Random(3)
    texts = [talk(rng, ["moronic"] * (i % 2)) for i in range(10)] + ["", "!?", "moronic", "é" * 10]
    assert model.score(texts).tolist() == pytest.approx([model.score([t])[0] for t in texts])


def test_hostile_rows(docs, model):
    rows = docs((1, None), (1, None), (None, ""), (2, "moronic " * 100_000), (3, "?"))
    out = toxicity.with_toxicity(rows, model)
    assert out.columns == [c for c in rows.columns if c != "Score"] + ["score"]
    scores = {r.doc_id: r.score for r in out.collect()}
    assert all(0 <= s <= 1 for s in scores.values()) and scores[1] == scores[None] == scores[3]
    assert toxicity.with_toxicity(rows.where("false"), model).count() == 0


def test_labels_of_held_out_rows_are_never_used(spark, docs):
    rows = docs(*[(i, f"text {i}") for i in range(60)])
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(60)] + [(None, 1, 1), (3, 1, None)], LABELS)
    usable = labels.where(~toxicity.held_out())
    texts, found = toxicity.sample(rows, usable, 100)
    texts = [t for [t] in texts]
    import zlib

    want = {f"text {i}" for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1}
    assert set(texts) == want and all(int(t.split()[1]) % 2 == y for t, y in zip(texts, found))


def test_one_class_or_no_labels(spark, docs):
    rows = docs((1, "a b"), (2, "c d"))
    for labels in ([], [(1, 1, 0), (2, 1, 0)]):
        made = spark.createDataFrame(labels, LABELS)
        scored = toxicity.with_toxicity(rows, toxicity.learn(rows, made))
        assert scored.where(F.col("score") >= toxicity.THRESHOLD).count() == 0


def naive_words(text):
    """All words at once, character by character."""
    kept = []
    for c in text:
        known = unicodedata.category(c)[0] in "LMN"
        kept.append(c.lower() if known and len(c.lower()) == 1 else c if known else " ")
    out = []
    for word in "".join(kept).split():
        pieces = [word] if len(word) <= toxicity.RUN else [
            word[j : j + toxicity.RUN] for j in range(0, len(word) - toxicity.OVERLAP, toxicity.RUN - toxicity.OVERLAP)
        ]
        for piece in pieces:
            if not out or piece != out[-1]:
                out.append(piece)
    return out


def naive_score(model, text):
    """Bag by bag and n-gram by n-gram."""
    bags, grams_held = [], 0
    for word in naive_words(text):
        grams = [f" {word} "[i : i + n] for n in toxicity.LENGTHS for i in range(len(word) + 3 - n)]
        if not bags or len(bags[-1]) == toxicity.BAG_WORDS or grams_held + len(grams) > toxicity.BAG_GRAMS:
            bags.append([])
            grams_held = 0
        bags[-1].append(grams)
        grams_held += len(grams)
    if len(bags) > 1 and 2 * len(bags[-1]) < toxicity.BAG_WORDS:
        bags[-2:] = [bags[-2] + bags[-1]]
    logits = []
    for bag in bags:
        total, count = 0.0, 0
        for gram in (g for grams in bag for g in grams):
            h = 0
            for c in gram:
                h = (h * 0x9E3779B97F4A7C15 + ord(c)) % 2**64
            spot = mixed(np.array([h ^ len(gram)], np.uint64))[0] >> np.uint64(65 - toxicity.BUCKETS.bit_length())
            total += float(model.parts[int(spot)])
            count += 1
        logits.append(model.bias + total / max(count, toxicity.LEAST_GRAMS))
    return 1 / (1 + np.exp(-max(logits, default=model.bias)))


ODD = ["", "a", "a b", "!?", "x" * 39 + " y", "x" * 40, "x" * 41, "x" * 47, "x" * 300 + " " + "ab" * 100, "moronic moronic moronic",
       "ΣΑΣ İstanbul हिन्दी में", "\u4f60\u597d" * 200, "a\u2014b\u00b7c\u3001d", "  lead and trail  ", "\ud7ff\u00a0x", "1d10t 99"]


@pytest.mark.parametrize("part", [1, 7, 64, 1 << 16])
def test_scores_against_brute_force(model, monkeypatch, part):
    monkeypatch.setattr(toxicity, "_PART", part)
    rng = random.Random(5)
    texts = ODD + [talk(rng, ["moronic"] * (i % 2)) for i in range(6)]
    for text in texts:
        assert list(toxicity.words(text)) == naive_words(text)
    assert model.score(texts).tolist() == pytest.approx([naive_score(model, t) for t in texts])


@pytest.mark.parametrize("mark", list("\u00b7\u2014\u2013\u2026\u00ab\u3001\u3000\u2022\u2032\u2016\u200b") + [" ", "\n", "_"])
def test_toxic_words_between_any_separators(model, mark):
    rng = random.Random(6)
    clean = [mark.join(talk(rng, []).split()) for _ in range(20)]
    assert (model.score(clean) < 0.7).mean() >= 0.9
    assert (model.score([c + mark + "moronic" + mark + "stupido" + mark + c for c in clean]) >= 0.7).mean() >= 0.9


def test_memory_does_not_grow_with_a_text(model):
    import tracemalloc

    text = talk(random.Random(7), []) + " "
    tracemalloc.start()
    try:
        peaks = []
        for times in (500, 5000):
            long = text * times + "moronic stupido " + text * times
            tracemalloc.reset_peak()
            held, _ = tracemalloc.get_traced_memory()
            assert model.score([long])[0] >= 0.7
            peaks.append(tracemalloc.get_traced_memory()[1] - held)
    finally:
        tracemalloc.stop()
    assert peaks[1] < 1.5 * peaks[0] and peaks[1] < 60e6


def test_examples_come_from_whole_texts(spark, docs):
    long = " ".join(f"word{i}" for i in range(8 * 5000))
    rows = docs((1, long), (2, "short text"))
    labels = spark.createDataFrame([(1, 1, 1), (2, 1, 0)], LABELS)
    texts, found = toxicity.sample(rows, labels, 10)
    assert found == [0, 1] and texts[0] == ["short text"] and len(texts[1]) == toxicity.SAMPLE_BAGS
    places = [int(b.split()[0][4:]) for b in texts[1]]
    assert places == sorted(places) and min(places) < 2000 and max(places) > 38_000


def test_a_class_without_its_documents_is_named(spark, docs):
    rows = docs((1, "a b"), (2, "c d"))
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (99, 1, 1)], LABELS)
    with pytest.warns(UserWarning, match="class 1"):
        toxicity.sample(rows, labels, 10)


def test_held_out_accuracy(spark):
    folder = SMALL.replace("sf0.001", "sf0.1")
    found = checks.QUERIES["op10_toxicity"](spark, folder).where("held_out")
    met = found.join(checks.table(spark, folder, "labels"), "doc_id").collect()
    toxic = [r for r in met if r.toxic == 1]
    clean = [r for r in met if r.toxic == 0]
    # About one in twenty of the toxic labels here stands on a text without any toxic word, and words
    # like the toxic ones of three of the languages occur in long clean texts by chance.
    sizes = {r.doc_id: r.n_chars for r in checks.table(spark, folder, "documents").select("doc_id", "n_chars").collect()}
    for long, caught, alarms in ((False, 0.85, 0.012), (True, 0.85, 0.08)):
        some = [r for r in toxic if (sizes[r.doc_id] > 6000) == long]
        assert sum(r.predicted for r in some) / len(some) > caught
        some = [r for r in clean if (sizes[r.doc_id] > 6000) == long]
        assert sum(r.predicted for r in some) / len(some) < alarms
