"""The rollup kept by a stream against one refresh, over cuts, late calls, failures and restarts."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from checks.fixtures import AS_OF
from checks.streaming_checks import time_parts
from spendlens.operators import tracking
from spendlens.plans.distinct import bitmaps_within, distinct_users, user_bitmaps
from spendlens.plans.rollup import hourly_rollup
from spendlens.sources import keyed
from spendlens.streaming import rollup, spend
from tests.util import rows

SCHEMA = "user_id bigint, function_name string, model_name string, tokens bigint, at timestamp_ntz, credits decimal(18,9)"
START = datetime(2024, 1, 1)


def made(seed, n=300):
    rng = random.Random(seed)
    calls = [
        (rng.choice([1, 1, 2, None]), rng.choice(["f", "g"]), rng.choice(["m", None]), rng.randrange(100),
         START + timedelta(minutes=rng.randrange(4 * 1440)), Decimal(rng.randrange(1, 900)) / 1000)
        for _ in range(n)
    ]
    return calls + [(3, "f", "m", 5, None, Decimal(1)), (3, "f", "m", 7, None, Decimal(2))]


def whole(spark, calls):
    return sorted((tuple(r) for r in hourly_rollup(spark.createDataFrame(calls, SCHEMA), "at", "credits").collect()), key=repr)


def kept(spark, path):
    return sorted((tuple(r) for r in rollup.read_rollup(spark, path).collect()), key=repr)


@pytest.mark.parametrize("seed, cuts", [(1, 1), (2, 4), (3, 7)])
def test_any_cut_and_restart_equals_one_refresh(spark, tmp_path, seed, cuts):
    """Calls come in no order at all, so every batch corrects older days."""
    calls, path = made(seed), str(tmp_path / "out")
    random.Random(seed).shuffle(calls)
    size = -(-len(calls) // cuts)
    for i in range(0, len(calls), size):
        spark.createDataFrame(calls[i : i + size], SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spend.read_calls(spark, str(tmp_path / "in"), spark.createDataFrame([], SCHEMA).schema)
        rollup.write_rollup(stream, path, str(tmp_path / "cp"), "at", "credits", True).awaitTermination()
    assert kept(spark, path) == whole(spark, calls)


def test_a_repeated_batch_counts_once(spark, tmp_path, monkeypatch):
    calls, path = made(4, 60), str(tmp_path / "out")
    first, second = spark.createDataFrame(calls[:30], SCHEMA), spark.createDataFrame(calls[30:], SCHEMA)
    assert rollup.merge_batch(first, 0, path, "at", "credits")
    assert not rollup.merge_batch(first, 0, path, "at", "credits")
    for where in ("store", "commit"):
        real = getattr(keyed, where)

        def dies(*args, real=real, where=where):
            if where == "store":
                real(*args)
            raise KeyboardInterrupt

        monkeypatch.setattr(keyed, where, dies)
        with pytest.raises(KeyboardInterrupt):
            rollup.merge_batch(second, 1, path, "at", "credits")
        monkeypatch.undo()
        assert kept(spark, path) == whole(spark, calls[:30])
    assert rollup.merge_batch(second, 1, path, "at", "credits")
    assert kept(spark, path) == whole(spark, calls)


def test_only_touched_days_are_written(spark, tmp_path):
    path, calls = str(tmp_path / "out"), made(5)
    rollup.merge_batch(spark.createDataFrame(calls, SCHEMA), 0, path, "at", "credits")
    before = keyed.manifest(spark, path).folders
    late = [(1, "f", "m", 1, START + timedelta(days=2), Decimal(1))]
    rollup.merge_batch(spark.createDataFrame(late, SCHEMA), 1, path, "at", "credits")
    after = keyed.manifest(spark, path).folders
    assert len([d for d in after if after[d] != before[d]]) == 1 and len(after) == 5


def test_reports_take_the_rollup(spark, tables, tmp_path):
    calls = tables.ai_function_usage
    rollup.merge_batch(calls.where("user_id % 2 = 0"), 0, str(tmp_path), "start_time", "credits")
    rollup.merge_batch(calls.where("user_id % 2 = 1"), 1, str(tmp_path), "start_time", "credits")
    got = tracking.spend_by_function(rollup.read_rollup(spark, str(tmp_path)), AS_OF, days=30)
    assert rows(got) == rows(tracking.spend_by_function(calls, AS_OF, days=30))


def test_time_parts_keep_every_row(spark):
    calls = made(6, 200)
    df = spark.createDataFrame(calls, SCHEMA)
    parts = time_parts(df, F.col("at"), 3)
    got = [sorted(map(repr, map(tuple, p.collect()))) for p in parts]
    assert sorted(sum(got, [])) == sorted(repr(tuple(r)) for r in df.collect()) and all(got)
    assert [p.where("at IS NULL").count() for p in parts] == [0, 0, 2]
    for early, late in zip(parts, parts[1:]):
        assert early.agg(F.max("at")).first()[0] <= late.agg(F.min("at")).first()[0]
    assert [p.count() for p in time_parts(df.where("at IS NULL"), F.col("at"), 3)] == [2]


def test_bitmaps_count_users_of_any_hours(spark):
    rng = random.Random(7)
    ids = [0, 1, -1, 32_767, 32_768, 32_769, -32_768, 10**12, None]
    calls = [(rng.choice(ids), rng.choice("fg"), "m", 1, START + timedelta(minutes=rng.randrange(2 * 1440)), Decimal(1)) for _ in range(300)]
    df = spark.createDataFrame(calls, SCHEMA)
    bitmaps = user_bitmaps(df, "at")
    for hours in (1, 7, 48):
        end = START + timedelta(hours=48)
        inside = df.where((F.col("at") >= F.lit(end - timedelta(hours=hours))) & (F.col("at") < F.lit(end)))
        part = bitmaps_within(bitmaps, end, hours=hours)
        assert distinct_users(part).first()[0] == inside.agg(F.countDistinct("user_id")).first()[0]
        by = inside.groupBy("function_name").agg(F.countDistinct("user_id"))
        assert sorted(rows(distinct_users(part, "function_name"))) == sorted(rows(by))
    assert distinct_users(bitmaps.where("false")).first()[0] == 0
    assert bitmaps.agg(F.max(F.octet_length("users"))).first()[0] == 4096
    with pytest.raises(ValueError, match="hour"):
        bitmaps_within(bitmaps, "2024-01-02 00:30:00", hours=1)
