"""The label cache: what is scored again, and what moves to meet it."""

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlens.operators import prompts
from spendlens.sources import labels as labels_module
from spendlens.sources.labels import open_cache

LABELS = T.StructType([T.StructField("size", T.LongType())])
DOCS = "doc_id bigint, text string"


@pytest.fixture
def scored(spark):
    return spark.sparkContext.accumulator(0)


@pytest.fixture
def scorer(scored):
    def score(texts):
        scored.add(len(texts))
        return pd.DataFrame({"size": texts.str.len().astype("int64")})

    return score


def run(spark, docs, scorer, cache, version, folder):
    df = prompts.enrich_cached(spark.createDataFrame(docs, DOCS), scorer, cache, version, str(folder), max_tokens=50)
    return sorted(((r.doc_id, r["size"]) for r in df.collect()), key=repr)


def test_a_text_is_scored_once_per_version(spark, tmp_path, scorer, scored):
    cache = open_cache(spark, str(tmp_path / "it's a cache"), LABELS, 4)
    docs = [(i, f"text {i % 10}") for i in range(40)] + [(50, None), (51, "x" * 400), (None, "no key"), (1, "other")]
    want = sorted([(i, None if t is None or len(t) > 200 else len(t)) for i, t in docs], key=repr)
    assert run(spark, docs, scorer, cache, "v1", tmp_path / "1") == want and scored.value == 12
    assert run(spark, docs, scorer, cache, "v1", tmp_path / "2") == want and scored.value == 12
    more = docs + [(60, "new"), (61, "text 3")]
    assert len(run(spark, more, scorer, cache, "v1", tmp_path / "3")) == 46 and scored.value == 13
    assert run(spark, docs, scorer, cache, "v2", tmp_path / "4") == want and scored.value == 25


def test_a_new_session_finds_the_labels(spark, tmp_path, scorer, scored):
    path, docs = str(tmp_path / "cache"), [(i, f"text {i}") for i in range(9)]
    cache = open_cache(spark, path, LABELS, 4)
    run(spark, docs, scorer, cache, "v1", tmp_path / "1")
    spark.sql(f"DROP TABLE {cache.name}")
    again = open_cache(spark, path, LABELS, 4)
    assert len(run(spark, docs, scorer, again, "v1", tmp_path / "2")) == 9 and scored.value == 9


def test_a_run_that_dies_is_taken_up(spark, tmp_path, scorer, scored, monkeypatch):
    cache = open_cache(spark, str(tmp_path / "cache"), LABELS, 4)
    docs = [(i, f"text {i}") for i in range(20)]
    real = labels_module.LabelCache.add

    def dies(self, rows, version):
        real(self, rows.where(F.col("size") < 7), version)  # those of one digit were kept
        raise KeyboardInterrupt

    monkeypatch.setattr(labels_module.LabelCache, "add", dies)
    with pytest.raises(KeyboardInterrupt):
        run(spark, docs, scorer, cache, "v1", tmp_path / "1")
    monkeypatch.undo()
    before = scored.value
    assert len(run(spark, docs, scorer, cache, "v1", tmp_path / "2")) == 20
    assert scored.value - before == 10


def parents(plan, node):
    """The lines of a plan above a node, from it to the root."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if node in line)
    depth, found = len(lines[at]) - len(lines[at].lstrip(" :+-")), []
    for line in reversed(lines[:at]):
        if (here := len(line) - len(line.lstrip(" :+-"))) < depth:
            found.append(line)
            depth = here
    return found


def test_the_cache_does_not_move(spark, tmp_path, scorer):
    cache = open_cache(spark, str(tmp_path / "cache"), LABELS, 16)
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(500)], DOCS)
    prompts.enrich_cached(docs, scorer, cache, "v1", str(tmp_path / "1"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        rows = prompts.hashed_inputs(docs, str(tmp_path / "2"))
        asked = rows.groupBy("text_hash").count()
        for how in ("inner", "left_anti"):
            met = asked.join(cache.of("v1"), "text_hash", how)
            met.collect()
            plan = met._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
            above = parents(plan, f"FileScan parquet spark_catalog.default.{cache.name}")
            up_to_join = above[: next(i for i, line in enumerate(above) if "Join" in line)]
            assert not any("Exchange" in line or "Shuffle" in line for line in up_to_join), plan
            assert "Bucketed: true" in plan and "SelectedBucketsCount: 16 out of 16" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_texts_are_read_once_when_all_are_known(spark, tmp_path, scorer):
    cache = open_cache(spark, str(tmp_path / "cache"), LABELS, 4)
    source = str(tmp_path / "docs")
    spark.createDataFrame([(i, f"text {i}") for i in range(50)], DOCS).write.parquet(source)
    docs = spark.read.parquet(source)
    prompts.enrich_cached(docs, scorer, cache, "v1", str(tmp_path / "1")).collect()
    found = prompts.enrich_cached(docs, scorer, cache, "v1", str(tmp_path / "2"))
    assert "text:string" not in found._jdf.queryExecution().executedPlan().toString().replace("_text:string", "")
