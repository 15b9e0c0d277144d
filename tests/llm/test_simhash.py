import random

import numpy as np
import pytest
import xxhash

from spendlens.llm import checks, simhash
from spendlens.llm.components import components
from tests.conftest import SMALL

WORDS = "the cat sat on a mat and saw two birds fly over that old grey house".split()


def naive_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def naive_components(fps, ids, distance=2):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                root[find(i)] = find(j)
    least = {}
    for i, n in enumerate(ids):
        r = find(i)
        least[r] = n if least.get(r) is None else (least[r] if n is None else min(least[r], n))
    return [least[find(i)] for i in range(len(fps))]


def test_query_matches_brute_force(spark):
    table = checks.table(spark, SMALL, "documents").select("doc_id", "text").collect()
    fps = [naive_fingerprint(r.text) for r in table]
    roots = naive_components(fps, [r.doc_id for r in table])
    want = {r.doc_id: (f"{fp:016x}", root) for r, fp, root in zip(table, fps, roots)}
    got = checks.QUERIES["op9_simhash_dedup"](spark, SMALL).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == want
    assert len(set(roots)) < len(roots)


@pytest.mark.parametrize("text", ["", " \n\t", "One", "Two words", "É é É é", "A b C " * 5000])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) & (1 << 64) - 1 == naive_fingerprint(text)


def test_dense_groups_are_linked_exactly(spark):
    rng = random.Random(5)
    seeds = [rng.getrandbits(64) for _ in range(6)]
    fps = {s ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(5))) for s in seeds for _ in range(60)}
    fps = [f & (1 << 64) - 1 for f in sorted(fps)]
    rows = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp bigint")
    star = {r.node: r.root for r in components(simhash.links(rows)).collect()}
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    got = [star.get(s, s) for s in signed]
    want = naive_components(fps, signed)
    assert got == want


def test_hostile_rows(docs):
    text = " ".join(WORDS)
    rows = docs((None, text), (7, text), (3, text), (3, text), (4, None), (9, ""), (5, "x"), (None, "lone"))
    found = simhash.near_duplicates(rows).collect()
    by_text = {}
    for r in found:
        by_text.setdefault((r.doc_id, r.fp), []).append(r.component_id)
    assert len(found) == 8
    same = [r.component_id for r in found if r.fp == simhash_of(text)]
    assert same == [3, 3, 3, 3]
    assert {r.component_id for r in found if r.fp == 0} == {4}
    assert [r.component_id for r in found if r.fp == simhash_of("lone")] == [None]
    kept = simhash.one_of_each(rows)
    assert kept.columns == rows.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [
        (False, 3), (False, 4), (False, 5), (True, 0)]


def simhash_of(text):
    return simhash.fingerprint(text.encode())


def test_empty_table(docs):
    rows = docs((1, "a")).where("false")
    assert simhash.near_duplicates(rows).count() == 0
    assert simhash.one_of_each(rows).count() == 0


def test_components_of_a_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(5, 5)]
    star = components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()
    assert {(r.node, r.root) for r in star} == {(i, 0) for i in range(1, 41)} | {
        (100 + i, 100) for i in range(1, 60)}


def test_bucket_stars_hold_no_pair_twice():
    fp = np.array([0, 1, 3, 2, 1 << 40], np.uint64)
    tables = np.zeros((5, 16), np.int16)
    one, other = simhash.bucket_links(np.zeros(5, np.int64), fp, tables, 2)
    assert sorted(one.tolist()) == [1, 2, 3] or len(one) == 4
