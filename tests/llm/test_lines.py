import random

import numpy as np
import pytest

from spendlens.llm import lines


def naive(rows, least=10):
    def key(line):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in line)
        return low.strip(" \t\n\v\f\r")

    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(i)
    out = []
    for i, text in rows:
        split = (text or "").split("\n")
        stay = [x for x in split
                if len(key(x)) < least or len(holders[key(x)]) < 2 or min(holders[key(x)]) == i]
        out.append((i, "\n".join(stay), len(split), len(split) - len(stay)))
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.select("doc_id", "text", "n_lines", "n_dropped").collect())


def test_random_texts(docs):
    rng = random.Random(2)
    pool = [f"  Line number {i} é" for i in range(30)] + ["short", "", " ", "ÄÖÜ ÄÖÜ Ä", "SAME line AGAIN", "same LINE again  "]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(8)))) for i in range(60)]
    assert result(lines.dedup_lines(docs(*rows))) == naive(rows)


def test_hostile_rows(docs):
    shared = "a line that is long enough"
    rows = docs((2, shared), (1, f"{shared}\n{shared.upper()}\nx"), (1, f"{shared}\n{shared.upper()}\nx"),
                (3, None), (4, ""), (None, shared), (None, f"other\n{shared}"))
    out = lines.dedup_lines(rows)
    assert out.columns == [*rows.columns, "n_lines", "n_dropped"]
    assert result_keyed(out) == [
        (1, f"{shared}\n{shared.upper()}\nx", 3, 0), (1, f"{shared}\n{shared.upper()}\nx", 3, 0),
        (2, "", 1, 1), (3, "", 1, 0), (4, "", 1, 0), (99, "", 1, 1), (99, "other", 2, 1)]


def result_keyed(df):
    return sorted((99 if r.doc_id is None else r.doc_id, r.text, r.n_lines, r.n_dropped) for r in df.collect())


def test_empty_table(docs):
    assert lines.dedup_lines(docs((1, "a")).where("false")).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_perfect_hash_is_minimal(n):
    h = np.random.default_rng(n).integers(-(1 << 62), 1 << 62, n, dtype=np.int64)
    sizes, bits, place = lines.build_shard(h)
    assert sorted(place.tolist()) == list(range(n))
    rank = np.cumsum(bits) - 1
    assert lines.find(h, sizes, bits, rank).tolist() == place.tolist()


def test_long_text(docs):
    text = "\n".join(f"line with number {i}" for i in range(20000))
    rows = [(1, text), (2, text + "\nand one more line")]
    assert result(lines.dedup_lines(docs(*rows))) == naive(rows)
