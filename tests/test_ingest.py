"""Taking over a late source: several rounds against one full load."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from spendlens.sources import ingest, logs

START = datetime(2024, 1, 1)
SCHEMA = "query_id string, user_id bigint, at timestamp_ntz, credits decimal(18,9), tags map<string,string>"


def calls(rng, n=300):
    rows = []
    for i in range(n):
        at = START + timedelta(seconds=rng.randrange(5 * 86_400))
        rows.append((f"q{i}", rng.randrange(4), at, Decimal(rng.randrange(100)) / 7, {"a": str(i)}))
    return rows


def held(spark, path):
    rows = logs.read_log(spark, path).drop("event_date").collect()
    return sorted((tuple(r) for r in rows), key=repr)


def exact(spark, rows):
    return sorted((tuple(r) for r in spark.createDataFrame(rows, SCHEMA).collect()), key=repr)


def rounds(spark, path, rows, delays, cuts, rng):
    for cut in cuts:
        seen = [r for r, d in zip(rows, delays) if r[2] is None or r[2] + d <= cut]
        seen += rng.sample(seen, len(seen) // 5)
        rng.shuffle(seen)
        ingest.ingest(spark.createDataFrame(seen, SCHEMA), path, "at")


def test_rounds_equal_one_load(spark, tmp_path):
    rng = random.Random(1)
    rows = calls(rng)
    delays = [timedelta(minutes=rng.randrange(45)) for _ in rows]
    cuts = [START + timedelta(hours=h) for h in (5, 30, 31, 31, 80, 200)]
    rounds(spark, str(tmp_path / "a"), rows, delays, cuts, rng)
    assert held(spark, str(tmp_path / "a")) == exact(spark, rows)
    assert ingest.high_water(spark, str(tmp_path / "a")) == max(r[2] for r in rows)


def test_odd_rows(spark, tmp_path):
    path, rng = str(tmp_path / "log"), random.Random(2)
    rows = calls(rng, 20)
    no_time = [("t1", 1, None, Decimal(1), None), ("t2", 2, None, None, None)]
    no_key = [(None, 1, START, Decimal(2), None), (None, 1, START, Decimal(3), None)]
    twice = [("q0", 9, rows[0][2] + timedelta(seconds=1), Decimal(9), None)]
    ingest.ingest(spark.createDataFrame(rows + no_time[:1] + no_key + no_key[:1] + twice, SCHEMA), path, "at")
    ingest.ingest(spark.createDataFrame(rows + no_time + no_key, SCHEMA), path, "at")
    assert held(spark, path) == exact(spark, rows + no_time + no_key)
    empty = str(tmp_path / "empty")
    assert ingest.ingest(spark.createDataFrame([], SCHEMA), empty, "at") is None


def test_a_round_that_dies_before_its_mark_is_repeated(spark, tmp_path, monkeypatch):
    path, rows = str(tmp_path / "log"), calls(random.Random(3), 60)
    half = sorted(rows, key=lambda r: r[2])[:30]
    ingest.ingest(spark.createDataFrame(half, SCHEMA), path, "at")
    mark = ingest.high_water(spark, path)

    def dies(*args):
        raise KeyboardInterrupt

    monkeypatch.setattr(ingest.Files, "put", dies)
    with pytest.raises(KeyboardInterrupt):
        ingest.ingest(spark.createDataFrame(rows, SCHEMA), path, "at")
    monkeypatch.undo()
    assert ingest.high_water(spark, path) == mark
    ingest.ingest(spark.createDataFrame(rows, SCHEMA), path, "at")
    assert held(spark, path) == exact(spark, rows)


def test_a_wrong_clock_waits(spark, tmp_path):
    path = str(tmp_path / "log")
    early, wrong = ("a", 1, START, Decimal(1), None), ("b", 1, datetime(2090, 1, 1), Decimal(1), None)
    late = ("c", 1, START + timedelta(hours=1), Decimal(1), None)
    ingest.ingest(spark.createDataFrame([early, wrong], SCHEMA), path, "at", as_of="2024-01-02")
    assert ingest.high_water(spark, path) == START
    ingest.ingest(spark.createDataFrame([early, late, wrong], SCHEMA), path, "at", as_of="2024-01-02")
    assert held(spark, path) == exact(spark, [early, late])


def test_the_overlap_reaches_both_scans(spark, tmp_path, monkeypatch):
    path, source = str(tmp_path / "log"), str(tmp_path / "source")
    spark.createDataFrame(calls(random.Random(4)), SCHEMA).write.parquet(source)
    ingest.ingest(spark.read.parquet(source), path, "at")
    seen = []
    monkeypatch.setattr(ingest, "write_log", lambda df, *args: seen.append(df))
    ingest.ingest(spark.read.parquet(source), path, "at")
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    try:
        plan = seen[0].groupBy().agg(F.count("*"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert plan.count("GreaterThanOrEqual(at,2024-01-05T") == 2
    assert "event_date" in plan[plan.index("PartitionFilters: [(isnull") :][:200]
