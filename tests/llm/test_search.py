import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from spendlens.llm import search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
UP = {c: c + 32 for c in range(65, 91)}


def naive(docs, items, k):
    """Every document scored for every item."""
    counts = [(i, Counter(TERM.findall((t or "").translate(UP)))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    texts = {}
    for i, t in items:
        texts.setdefault(i, set()).add(t or "")
    out = []
    for item, different in texts.items():
        query = Counter(w for t in different for w in TERM.findall(t.translate(UP)))
        scores = []
        for i, c in counts:
            n, score = sum(c.values()), 0
            for term, times in query.items():
                df = sum(term in other for _, other in counts)
                if tf := c.get(term, 0):
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                    m = 75 + 25 * n * n_docs // n_terms
                    score += times * w * (10**9 * tf // (1000 * tf + 12 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def found(docs, items, k):
    rows = search.search(docs, items, k).collect()
    return sorted([(r.item_id, r.rank, r.doc_id, r.score) for r in rows], key=repr)


def words(rng, n):
    return " ".join(f"w{min(rng.randrange(40), rng.randrange(40))}" for _ in range(n))


@pytest.mark.parametrize("k", [1, 7, 300])
def test_lists_against_full_scores(k):
    rng = np.random.default_rng(k)
    for _ in range(60):
        n = int(rng.integers(1, 200))
        ids = rng.permutation(n * 3)[:n]
        total, lists = np.zeros(n, np.int64), []
        for _ in range(int(rng.integers(1, 12))):
            doc = rng.permutation(n)[: rng.integers(1, n + 1)]
            score = np.sort(rng.integers(1, rng.choice([3, 1000]), len(doc)))[::-1]
            total[doc] += score
            lists.append((doc, score))
        best, score = search.nra(lists, ids, k)
        want = sorted((-s, i) for s, i in zip(total.tolist(), ids.tolist()) if s > 0)[:k]
        assert list(zip((-score).tolist(), ids[best].tolist())) == want


def test_reading_stops_before_the_end():
    score = np.arange(100_000, 0, -1)
    score[0] = 10**9

    class Watched(np.ndarray):
        read = 0

        def __getitem__(self, key):
            if isinstance(key, slice):
                Watched.read = max(Watched.read, key.stop)
            return super().__getitem__(key)

    best, _ = search.nra([(np.arange(100_000).view(Watched), score)], np.arange(100_000), 1)
    assert best.tolist() == [0] and Watched.read < 10


def test_against_brute_force(spark, docs, monkeypatch):
    monkeypatch.setattr(search, "BLOCK_ITEMS", 3)
    monkeypatch.setattr(search, "SHARD_POSTINGS", 40)
    monkeypatch.setattr(search, "SEARCH_POSTINGS", 100)
    monkeypatch.setattr(search, "PART", 50)
    rng = random.Random(3)
    rows = [(i, words(rng, rng.randrange(1, 60))) for i in range(80)]
    rows += rows[:10] + [(None, "W1 w2"), (200, "w1 w2"), (201, "w1 W2"), (202, None), (203, ""), (204, "?! ..")]
    rows += [(205, "w3 " * 3000), (206, "É w3é w4—w5\u0085w6")]
    items = [(i, words(rng, rng.randrange(1, 12))) for i in range(8)]
    items += [items[0], (1, "w39 w38 w38"), (20, None), (21, "?"), (22, "unseen"), (23, "É W3é"), (None, "w1 w2")]
    made = spark.createDataFrame(items, "item_id bigint, text string")
    for k in (3, 20):
        assert found(docs(*rows), made, k) == naive(rows, items, k)


def test_text_ids_and_empty_tables(spark, docs):
    made = spark.createDataFrame([("a", "one two"), ("b", "two")], "item_id string, text string")
    rows = [(1, "one"), (2, "two two three"), (3, "none of them four five")]
    assert found(docs(*rows), made, 20) == naive(rows, [("a", "one two"), ("b", "two")], 20)
    assert found(docs(*rows).where("false"), made, 20) == []
    assert found(docs(*rows), made.where("false"), 20) == []
