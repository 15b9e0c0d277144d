"""The operators of DataFrame functions alone: quality rules, licenses, preferences."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from spendlens.llm import checks, licenses, preferences, quality
from spendlens.llm.common import mixed
from tests.conftest import SMALL


def naive_repeats(words):
    spans = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(spans)
    return len({k for i, s in enumerate(spans) if often[s] > 1 for k in range(i, i + 8)})


def test_quality_measures(docs):
    period = "a b c d e f g h i "
    texts = [None, "", " \n\t", "one", "a b c d e f g h", "x " * 9, period * 3, f"{period} z {period}", "w " * 500,
             "Line #1\nline\nLine #1\n\n \nLine #1", "  é é <|>", "the and of " * 10]
    got = {r.doc_id: r for r in quality.quality(docs(*enumerate(texts))).collect()}
    for i, text in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\v\f\r")]
        r = got[i]
        assert (r.n_words, r.word_chars) == (len(words), sum(map(len, words)))
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", text or ""))
        assert (r.n_lines, r.n_dup_lines) == (len(lines), len(lines) - len(set(lines)))
        assert r.n_repeat_words == naive_repeats(words), text
        assert r.base_failed == (len(words) < 20 or 100 * r.n_repeat_words > 30 * len(words))
        assert r.kept == (not r.failed) and (not r.base_failed or r.failed)
    assert quality.quality(docs((1, "a")).where("false")).count() == 0


def test_clean_documents_are_kept(spark):
    labels = checks.table(spark, SMALL, "labels").where("quality = 1 and toxic = 0").select("doc_id").distinct()
    judged = checks.QUERIES["op7_quality_rules"](spark, SMALL).join(labels, "doc_id")
    assert judged.where("not base_failed and not kept").count() == 0
    assert judged.where("kept").count() > 20


def test_no_python_in_native_plans(spark):
    for name in ("op2_license_scan", "op5_preference_format", "op7_quality_rules"):
        plan = checks.QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan), name


def test_licenses_of_every_size(spark, docs):
    long = " ".join(f"word{i}" for i in range(300))
    torn = " ".join(w if i % 97 else "other" for i, w in enumerate(long.split()))
    table = spark.createDataFrame(
        [("A", "Released under the MIT License."), ("L", long), ("L", long), ("S", "too short text"), ("N", None)],
        "license string, text string")
    filler = " ".join(f"noise{i}" for i in range(1000))
    rows = docs(
        (1, f"{filler}\nreleased UNDER the mit license {filler}"), (1, f"{filler}\nreleased UNDER the mit license {filler}"),
        (None, f"{filler} {long} {filler}"), (3, f"{filler} {torn}"), (4, " ".join(long.split()[:200])),
        (5, None), (6, ""), (7, "under the mit license"), (8, filler))
    got = sorted(((r[0] or 0, r.license, round(r.containment, 2)) for r in licenses.find_licenses(rows, table).collect()))
    share = sum(len(set(torn.split()[i : i + 5]) - {"other"}) == 5 for i in range(296)) / 296
    assert got == [(0, "L", 1.0), (1, "A", 1.0), (1, "A", 1.0), (3, "L", round(share, 2))]
    assert licenses.find_licenses(rows, table.where("false")).count() == 0
    assert licenses.find_licenses(rows.where("false"), table).count() == 0


def test_licenses_of_few_words(spark, docs):
    table = spark.createDataFrame(
        [("R", "All rights reserved."), ("S", "SPDX-License-Identifier: MIT"), ("P", "Proprietary"), ("E", "!"),
         ("A", "Released under the MIT License."), ("A", "MIT")], "license string, text string")
    rows = docs((1, "(c) 2020 some one. all RIGHTS\nreserved"), (1, "(c) 2020 some one. all RIGHTS\nreserved"), (2, "// SPDX-License-Identifier: MIT"),
                (3, "all rights are reserved"), (None, "proprietary"), (4, ""), (5, None), (6, "x released under the MIT license"))
    got = sorted((r[0] or 0, r.license, r.containment, r.first_word) for r in licenses.find_licenses(rows, table).collect())
    assert got == [(0, "P", 1.0, 0), (1, "R", 1.0, 2), (1, "R", 1.0, 2), (2, "A", 1.0, 1), (2, "S", 1.0, 0), (6, "A", 1.0, 0)]


def test_band_count_keeps_the_promise():
    n = licenses.band_count(0.8, 0.999)
    assert 1 - (1 - 0.4 / 3.1) ** n >= 0.999 > 1 - (1 - 0.4 / 3.1) ** (n - 1)


def test_recall_of_the_bands_over_random_windows():
    """The worst case: the smallest template of its class, just enough of it, in a full window."""
    rng, n = np.random.default_rng(5), licenses.band_count()
    constants = mixed(np.arange(1001, 1001 + n, dtype=np.uint64)).view(np.int64)
    found, trials = 0, 4000
    for _ in range(trials):
        template = rng.integers(-(2**63), 2**63 - 1, 33)  # of class 64
        held = rng.permutation(template)[:27]
        window = np.concatenate((held, rng.integers(-(2**63), 2**63 - 1, 192 - 27)))
        least = [np.min(x[:, None] ^ constants, axis=0) for x in (template, window)]
        found += bool((least[0] == least[1]).any())
    assert found / trials >= 0.998


def test_whole_license_texts(spark, docs):
    texts = dict(licenses.known_texts())
    mit, apache = texts["MIT-text"], texts["Apache-2.0-text"]
    rng = random.Random(3)
    noise = lambda n: " ".join(f"w{rng.randrange(500)}" for _ in range(n))
    lines = apache.splitlines()
    most = "\n".join(line for i, line in enumerate(lines) if i % 40)  # a few lines are missing
    rows = docs((1, noise(300) + mit + noise(50)), (2, mit.split(",")[0]), (3, noise(900) + most), (4, "x. All rights\nreserved, 2020"), (5, noise(2000)))
    got = {(r[0], r.license) for r in licenses.find_licenses(rows, licenses.notices(spark)).collect()}
    assert {(1, "MIT-text"), (1, "MIT-permission"), (3, "Apache-2.0-text"), (4, "reserved")} <= got
    assert (2, "MIT-text") not in got and not any(i == 5 for i, _ in got)


def test_no_template_is_too_many(spark, docs, monkeypatch):
    """More templates than fit one scan are looked for in several."""
    monkeypatch.setattr(licenses, "MINIMA_PER_SCAN", 400)
    rng = random.Random(4)
    table = spark.createDataFrame(
        [(f"L{i}", " ".join(f"w{rng.randrange(60)}" for _ in range(rng.randrange(5, 12)))) for i in range(30)], "license string, text string")
    some = [r.text for r in table.orderBy("license").limit(5).collect()]
    rows = docs(*[(i, f"a b c {t} d e f") for i, t in enumerate(some)], (9, "nothing of these at all in this text here"))
    got = {(r[0], r.license) for r in licenses.find_licenses(rows, table).collect()}
    names = [r.license for r in table.orderBy("license").limit(5).collect()]
    assert {(i, name) for i, name in enumerate(names)} <= got and all(i != 9 for i, _ in got)


TURNS = "conv_id bigint, turn bigint, role string, text string"


def test_preference_pairs(spark):
    u, a = "user", "assistant"
    rows = [(1, 0, u, "hi"), (1, 1, a, "yes"), (2, 0, u, "hi"), (2, 1, a, "no"), (2, 1, a, "no"), (2, 2, u, "more"),
            (3, 0, u, "lone"), (3, 1, a, "first"), (3, 2, u, "q"), (3, 3, a, "second"),
            (4, 0, None, None), (None, 0, u, "hi"), (5, 0, u, "hi"), (5, 1, a, "yes"), (6, None, u, "x")]
    turns = spark.createDataFrame(rows, TURNS).withColumn("chosen", F.lit(1))
    out = {r.conv_id: r for r in preferences.format_pairs(preferences.paired_by_opening(turns)).collect()}
    assert {k: r.partner_id for k, r in out.items()} == {1: 2, 2: 1, 3: None, 4: None, 5: 2, 6: None}
    mark = lambda role, text: f"<|im_start|>{role}\n{text}<|im_end|>\n"
    two = out[2]
    assert two.prompt == mark(u, "hi") and two.n_prompt_turns == 1 and two.usable
    assert two.chosen_completion == mark(a, "no") + mark(u, "more")
    assert [two.chosen_completion[s.start : s.end] for s in two.chosen_spans] == ["no<|im_end|>\n"]
    assert [two.rejected_completion[s.start : s.end] for s in two.rejected_spans] == ["yes<|im_end|>\n"]
    assert out[3].n_prompt_turns == 3 and out[3].rejected_completion == mark(a, "first")
    assert out[1].chosen_completion == out[5].chosen_completion == mark(a, "yes") and out[1].usable
    assert out[6].chosen_completion == out[6].rejected_completion == "" and not out[6].usable
    assert out[4].prompt == mark("unknown", "") and not out[4].usable
    assert preferences.format_pairs(preferences.paired_by_opening(turns.where("false"))).count() == 0


def test_no_partner_is_a_copy(spark, tmp_path):
    u, a = "user", "assistant"
    talks = {1: ("hi", "yes"), 2: ("hi", "no"), 3: ("hi", "yes"), 4: ("hi", "maybe"), 5: ("hi", "yes"),
             6: ("same", "one"), 7: ("same", "one"), 8: ("go", "left"), 9: ("go", "right"), 10: ("go", "right"), 11: ("lone", "x")}
    rows = [(i, n, role, text) for i, pair in talks.items() for n, (role, text) in enumerate(zip((u, a), pair))]
    spark.createDataFrame(rows, TURNS).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in checks.QUERIES["op5_preference_format"](spark, str(tmp_path)).collect()}
    assert {k: r.partner_id for k, r in got.items()} == {
        1: 4, 2: 1, 3: 4, 4: 1, 5: 4, 6: None, 7: None, 8: 10, 9: 8, 10: 8, 11: None}
    assert all(r.usable for r in got.values())


def test_pairs_of_random_talks_against_sql(spark, tmp_path):
    """Shared openings, copies, ties and rows given twice: most conversations have a partner."""
    rng = random.Random(11)
    talks = {}
    for i in range(300):
        if i and rng.random() < 0.3:
            talks[i] = talks[rng.randrange(i)]  # a copy
            continue
        # A third of all begin alike.
        opening = "hi" if rng.random() < 0.33 else f"o{rng.randrange(40)}"
        rest = [(rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "é", "", None])) for _ in range(rng.randrange(6))]
        talks[i] = [("user", opening), *rest]
    rows = [(i * 7 % 300, n, role, text) for i, talk in talks.items() for n, (role, text) in enumerate(talk)]
    rows += rng.sample(rows, 50) + [(5, 1, "assistant", "tie"), (None, 0, "user", "hi"), (400, None, "user", "hi")]
    rng.shuffle(rows)
    spark.createDataFrame(rows, TURNS).write.parquet(f"{tmp_path}/conversations.parquet")
    out = checks.QUERIES["op5_preference_format"](spark, str(tmp_path))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    cursor = connection.execute(checks.ORACLES["op5_preference_format"])
    order = [d[0] for d in cursor.description]
    want = sorted(repr(tuple(r[order.index(c)] for c in out.columns)) for r in cursor.fetchall())
    got = out.collect()
    assert sorted(repr(tuple(r)) for r in got) == want
    partners = [r.partner_id for r in got]
    assert partners.count(None) < len(partners) / 4 and any(r.usable for r in got)


@pytest.mark.parametrize("n", [1, 255, 256, 257, 1000])
def test_spans_of_long_talks(spark, n):
    rng = random.Random(n)
    talk = [(rng.choice(["user", "assistant"]), "x" * rng.randrange(5)) for _ in range(n)]
    pairs = spark.createDataFrame([(talk, [])], "chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>")
    row = preferences.format_pairs(pairs).first()
    want, at = [], 0
    for role, text in talk:
        head, whole = len(f"<|im_start|>{role}\n"), len(f"<|im_start|>{role}\n{text}<|im_end|>\n")
        if role == "assistant":
            want.append((at + head, at + whole))
        at += whole
    assert [tuple(s) for s in row.chosen_spans] == want and row.rejected_spans == []


def test_pairs_given_by_the_caller(spark):
    pairs = spark.createDataFrame(
        [(1, [("user", "q"), ("assistant", "a")], None), (1, None, None)],
        "id bigint, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>",
    ).withColumn("_a", F.lit(1)).withColumn("Prompt", F.lit("gone"))
    got = preferences.format_pairs(pairs).collect()
    assert [(r.id, r._a, r.n_prompt_turns, r.prompt, r.usable) for r in got] == [(1, 1, 0, "", False)] * 2
