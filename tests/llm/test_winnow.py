import random
import re

import numpy as np
import pytest

from spendlens.llm import winnow

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEM = "item_id bigint, text string"


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def naive(rows, items):
    out = []
    for i, text in rows:
        mine, hit, found = words(text), set(), set()
        for item, item_text in items:
            theirs = words(item_text)
            n = min(10, len(theirs))
            windows = {tuple(theirs[k : k + n]) for k in range(len(theirs) - n + 1)} if n else set()
            for k in range(len(mine) - n + 1):
                if n and tuple(mine[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    if item is not None:
                        found.add(str(item))
        out.append((i, len(mine), len(hit), sorted(found), bool(hit)))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r[0], r.n_words, r.n_hit, r["items"], r.contaminated) for r in df.collect()), key=repr)


def test_random_texts(spark, docs):
    rng = random.Random(4)
    vocabulary = ["a", "Bee", "çé", "d4", "e", "FF", "gé", "h"]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, say(rng.choice([1, 3, 6, 9, 10, 11, 25]))) for i in range(12)] + [(50, ""), (51, None)]
    items = [(i, t) for i, t in items if len(words(t)) != 1]
    rows = []
    for i in range(40):
        text = say(rng.randrange(40))
        if i % 3 == 0:
            text += ", " + (rng.choice(items)[1] or "")
        rows.append((i, text))
    found = winnow.contamination(docs(*rows), spark.createDataFrame(items, ITEM))
    assert result(found) == naive(rows, items)


def test_hostile_rows(spark, docs):
    span = "one two three four five six seven eight nine ten"
    items = [(1, span), (2, span), (2, span), (None, "alpha beta"), (3, "!!"), (4, None)]
    rows = [(1, f"x {span} y {span}"), (1, f"x {span} y {span}"), (None, span.upper()), (5, None), (6, ""),
            (7, "alpha beta"), (8, "one two three four five six seven eight nine")]
    table = spark.createDataFrame(items, ITEM)
    assert result(winnow.contamination(docs(*rows), table)) == naive(rows, items)
    clean = winnow.clean_documents(docs(*rows), table)
    assert clean.columns == docs(*rows).columns
    assert sorted(r.doc_id for r in clean.collect()) == [5, 6, 8]


def test_empty_tables(spark, docs):
    items = spark.createDataFrame([(1, "a b")], ITEM)
    assert winnow.contamination(docs((1, "a")).where("false"), items).count() == 0
    assert result(winnow.contamination(docs((1, "a b")), items.where("false"))) == [(1, 2, 0, [], False)]


def test_long_text(spark, docs):
    rng = random.Random(8)
    text = " ".join(f"w{rng.randrange(10**9)}" for _ in range(300_000))
    span = " ".join(text.split()[200_000:200_012])
    rows, items = [(1, text)], [(9, span)]
    got = result(winnow.contamination(docs(*rows), spark.createDataFrame(items, ITEM)))
    assert got == [(1, 300_000, 12, ["9"], True)]


@pytest.mark.parametrize("seed", range(3))
def test_every_shared_window_shares_a_fingerprint(seed):
    rng = np.random.default_rng(seed)
    shared = rng.integers(0, 50, 10, dtype=np.uint64)
    for _ in range(50):
        sides = []
        for _ in range(2):
            before, after = (rng.integers(0, 50, rng.integers(0, 30), dtype=np.uint64) for _ in range(2))
            text = np.concatenate((before, shared, after))
            grams = winnow.gram_hashes(text, 5)
            sides.append(set(grams[winnow.winnowed(grams, np.zeros(len(text), np.int64), 10)].tolist()))
        assert sides[0] & sides[1]
