"""Registered queries against their SQL, and the pipeline against its parts done by hand."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from spendlens.llm import bpe, checks, toxicity
from tests.conftest import ROOT, SMALL
from tests.llm.test_lines import naive as naive_lines
from tests.llm.test_simhash import naive_components, naive_fingerprint
from tests.llm.test_winnow import naive as naive_hits

TABLES = "documents pages benchmark labels conversations".split()


@pytest.mark.parametrize("name", sorted(checks.ORACLES))
def test_matches_oracle(spark, name):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    result = checks.QUERIES[name](spark, SMALL)
    cursor = connection.execute(checks.ORACLES[name])
    order = [d[0] for d in cursor.description]
    assert sorted(order) == sorted(result.columns)
    want = sorted(repr(tuple(r[order.index(c)] for c in result.columns)) for r in cursor.fetchall())
    assert sorted(repr(tuple(r)) for r in result.collect()) == want


def test_one_query_per_operator():
    assert {n.split("_")[0] for n in checks.QUERIES} == {f"op{i}" for i in range(1, 14)}


def test_pipeline_against_brute_force(spark):
    docs = checks.table(spark, SMALL, "documents")
    model = toxicity.learn(docs, checks.table(spark, SMALL, "labels"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows = [(i, t) for i, t in rows if model.score([t])[0] < toxicity.THRESHOLD]
    rows = [(i, t) for i, t, _, _ in naive_lines(rows)]
    roots = naive_components([naive_fingerprint(t) for _, t in rows], [i for i, _ in rows])
    rows = [(i, t) for (i, t), root in zip(rows, roots) if i == root]
    items = [(r.item_id, r.text) for r in checks.table(spark, SMALL, "benchmark").collect()]
    dirty = {i for i, _, _, _, hit in naive_hits(rows, items) if hit}
    import numpy as np
    import public_tokenizers

    encoder = bpe.Encoder(checks.byte_bpe_model(), public_tokenizers.PATTERN)
    want = {i: np.frombuffer(encoder.ids(t), np.int32).tolist() for i, t in rows if i not in dirty}
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert len(got) == len(want) and all(r.intact for r in got)
    assert {r.doc_id: r.ids for r in got} == want


def test_stages_on_hostile_and_empty_rows(spark, docs):
    text = "words that make up a text of their own and go on for some while"
    rows = docs((1, None), (1, None), (None, text), (2, text), (2, text), (3, ""), (4, "x " * 50_000))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, rows, SMALL)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == rows.columns, name
        assert out.count() > 0, name
        assert stage(spark, rows.where("false"), SMALL).count() == 0, name


def test_entry_lists_queries_without_a_session():
    code = "import __spark_entry__ as e; q = e.queries(); print('op1_byte_bpe' in q, 'pipeline' in q)"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.stdout.split() == ["True", "True"], done.stderr


def test_nothing_else_imports_the_subpackage():
    for path in Path(ROOT).glob("**/*.py"):
        name = path.relative_to(ROOT).as_posix()
        if "llm/" in name or name in ("corpus_pipeline.py", "__spark_entry__.py"):
            continue
        assert "llm" not in path.read_text(), name
