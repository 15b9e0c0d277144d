import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from spendlens.llm import trie

ROWS = "conv_id bigint, turn int, role string, text string"


def naive(rows):
    """The trie with all sequences written out."""
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            talks[conv].append((turn is not None, turn or 0, (role or "") + "\0" + (text or ""), role or "", text or ""))
    talks = {c: [t[3:] for t in sorted(turns)] for c, turns in talks.items()}
    rebuilt = {}
    for c, own in talks.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        rebuilt[c] = talks.get(base, [])[:h] + own[h:]
    members = defaultdict(list)
    for c, turns in sorted(rebuilt.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    children = defaultdict(int)
    below = defaultdict(lambda: [0, 0])
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, convs in members.items():
        size = len(path[-1][1].encode()) if path else 0
        for d in range(len(path) + 1):
            below[path[:d]][0] += path not in children
            below[path[:d]][1] += (len(convs) - 1) * size
    for path, convs in members.items():
        ends = ",".join(str(c) for c in convs if len(rebuilt[c]) == len(path))
        out.append((convs[0], len(path), members[path[:-1]][0] if path else None, len(convs), children[path],
                    *below[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(spark, rows):
    made = spark.createDataFrame(rows, ROWS).withColumn("depth", F.lit(1)).withColumn("Fa", F.lit("x"))
    return sorted([tuple(r) for r in trie.prefix_trie(made).collect()], key=repr)


def talk(rng, conv, n, words=2):
    return [(conv, i, rng.choice(["user", "assistant"]), f"t{rng.randrange(words)}" + "é" * rng.randrange(2)) for i in range(n)]


def test_against_brute_force(spark):
    rng = random.Random(5)
    rows = [r for c in range(-7, 120) for r in talk(rng, c, rng.randrange(1, 14))]
    # Copies of one conversation, an absent base, and a large group with one opening.
    same = talk(rng, 0, 10)
    rows += [(c, *r[1:]) for c in range(1000, 1300) for r in same if c != 1005]
    rng.shuffle(rows)
    assert found(spark, rows) == naive(rows)


def test_hostile_rows(spark):
    rows = [(None, 1, "user", "lost"), (1, None, "user", "b"), (1, None, None, "b"), (1, 0, "user", None),
            (1, 0, "user", None), (1, 0, "user", ""), (2, None, None, None), (3, -5, "a\0b", "c"), (3, -5, "a", "b\0c"),
            (5, 1, "user", "x" * 100_000), (6, 1, "user", "x" * 100_000), (10**15, 2, "", "only")]
    rows += [(7, 3, "user", "again")] * 40 + [(40, i, "u", "w") for i in range(9)] + [(41, 1, "u", "w")]
    assert found(spark, rows) == naive(rows)
    assert found(spark, rows[:1]) == []


def test_a_long_conversation_spans_partitions(spark):
    rng = random.Random(6)
    rows = talk(rng, 10, 300, 9) + [(11, *r[1:]) for r in talk(rng, 11, 400, 9)]
    rows += [(c, *r[1:]) for c in (12, 13) for r in rows[300:]]
    rng.shuffle(rows)
    turns = trie._turns(spark.createDataFrame(rows, ROWS))
    prefixes = trie._prefixes(turns, 0)
    assert prefixes.select("conv_id", "pos").distinct().count() == len(rows)
    tie = {c: sorted((t, r + "\0" + x) for k, t, r, x in rows if k == c) for c in (10, 12)}
    for c, turns_of in tie.items():
        want, got = 0, {r.pos: r.pb for r in prefixes.where(F.col("conv_id") == c).collect()}
        for i, (_, content) in enumerate(turns_of, 1):
            want += len(content.split("\0")[1].encode())
            assert got[i] == want
    assert found(spark, rows) == naive(rows)


def weak_hash(seed):
    if seed == 0:
        return F.xxhash64(F.length("text")), F.lit(0).cast("bigint")
    return F.xxhash64(F.lit(seed), "role", "text"), F.xxhash64(F.lit(-seed), "role", "text")


@pytest.mark.parametrize("name, weak", [
    ("turn_hash", weak_hash),
    # With r = 1 the order of turns is lost, so other prefixes get equal fingerprints.
    ("bases", lambda seed, real=trie.bases: [1] * 4 if seed == 0 else real(seed)),
])
def test_collisions_are_noticed(spark, monkeypatch, name, weak):
    rng = random.Random(8)
    rows = [r for c in range(60) for r in talk(rng, c, 12)]
    monkeypatch.setattr(trie, name, weak)
    assert found(spark, rows) == naive(rows)
    monkeypatch.setattr(trie, "ATTEMPTS", 1)
    with pytest.raises(ValueError, match="fingerprints"):
        found(spark, rows)
