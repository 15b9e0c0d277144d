"""Streams fed in several batches, with late rows and a restart, against batch."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from spendlens.functions.tags import tag_value
from spendlens.streaming import sinks, spend

START = datetime(2024, 1, 1)
SCHEMA = (
    "user_id bigint, function_name string, query_tag string, at timestamp_ntz, "
    "credits decimal(18,9)"
)


def make_calls(n=400, seed=5):
    """Calls over three days in time order, half of them by one user."""
    rng = random.Random(seed)
    minutes = sorted(rng.randrange(0, 3 * 24 * 60) for _ in range(n))
    return [
        (
            rng.choice([1, 1, 2, 3]),
            rng.choice(["AI_FILTER", "AI_COMPLETE"]),
            rng.choice(["team=a", "team=b", None]),
            START + timedelta(minutes=m, seconds=rng.randrange(60)),
            Decimal(rng.randrange(1, 900)) / 1000,
        )
        for m in minutes
    ]


class Feed:
    """A folder that receives one parquet file per batch, and a stream over it."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, str(folder)
        self.given = []

    def add(self, calls):
        df = self.spark.createDataFrame(calls, SCHEMA)
        df.coalesce(1).write.mode("append").parquet(self.folder)
        self.given += calls

    def stream(self):
        return spend.read_calls(self.spark, self.folder, self.spark.createDataFrame([], SCHEMA).schema)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path / "in")


def chunks(calls, n):
    size = -(-len(calls) // n)
    return [calls[i : i + size] for i in range(0, len(calls), size)]


def hourly(stream):
    return spend.stream_hourly_spend(stream, "at", "credits")


def run_hourly(feed, tmp_path):
    query = sinks.write_updates(
        hourly(feed.stream()), str(tmp_path / "out"), str(tmp_path / "cp"),
        ["hour_bucket", "function_name"], available_now=True, compact_every=2,
    )
    query.awaitTermination()
    schema = hourly(feed.stream()).schema
    return sinks.read_updates(feed.spark, str(tmp_path / "out"), ["hour_bucket", "function_name"], schema)


def expected_hours(calls):
    sums = {}
    for _, function, _, at, credits in calls:
        key = (at.replace(minute=0, second=0), function)
        n, c = sums.get(key, (0, Decimal(0)))
        sums[key] = (n + 1, c + credits)
    return {k: (n, float(c)) for k, (n, c) in sums.items()}


def by_hour(df):
    df = df.withColumn("hour_bucket", F.col("hour_bucket").cast("timestamp_ntz"))
    return {(r.hour_bucket, r.function_name): (r.ai_calls, r.ai_credits) for r in df.collect()}


def test_hourly_over_batches_and_restarts(feed, tmp_path):
    """Each batch is a new query on the same checkpoint, that is, a restart."""
    for part in chunks(make_calls(), 4):
        feed.add(part)
        result = run_hourly(feed, tmp_path)
    assert by_hour(result) == expected_hours(feed.given)
    again = run_hourly(feed, tmp_path)
    assert by_hour(again) == expected_hours(feed.given)


def test_late_rows_beyond_the_watermark_drop(feed, tmp_path):
    def call(minute):
        return (1, "AI_FILTER", None, START + timedelta(minutes=minute), Decimal(1))

    feed.add([call(600)])
    run_hourly(feed, tmp_path)
    # The watermark is now 555 minutes: the hour of minute 540 is open, that of 470 closed.
    feed.add([call(560), call(470)])
    result = by_hour(run_hourly(feed, tmp_path))
    assert {at.hour for at, _ in result} == {9, 10}


def test_budget_burn_over_batches(spark, feed, tmp_path):
    limits = spark.createDataFrame([("a", 40), ("b", 100_000)], "scope string, credits bigint")
    scope = tag_value(F.col("query_tag"), "team")

    def burn():
        return spend.stream_budget_burn(feed.stream(), limits, scope, "at", "credits")

    for part in chunks(make_calls(seed=6), 3):
        feed.add(part)
        sinks.write_updates(
            burn(), str(tmp_path / "out"), str(tmp_path / "cp"), ["scope", "month"], True, 2
        ).awaitTermination()
    assert (tmp_path / "out" / "state" / "batch_id=1").exists()
    state = sinks.read_updates(
        spark, str(tmp_path / "out"), ["scope", "month"], burn().schema
    )
    got = {r.scope: (r.spend, r.reached_pct) for r in state.collect()}
    spent = {
        team: sum(c for _, _, tag, _, c in feed.given if tag == f"team={team}") for team in "ab"
    }
    used = spent["a"] * 100 / 40
    reached = max([0.0, *[float(t) for t in (50, 75, 80, 90) if used >= t]])
    assert got == {"a": (float(spent["a"]), reached), "b": (float(spent["b"]), 0.0)}


def expected_rolling(calls, released):
    minutes = {}
    for user, _, _, at, credits in calls:
        key = (user, at.replace(second=0))
        minutes[key] = minutes.get(key, Decimal(0)) + credits
    minutes = {k: c for k, c in minutes.items() if k[1] + timedelta(minutes=1) <= released}
    day = timedelta(hours=24)
    return {
        (user, m): float(
            sum(c for (u, t), c in minutes.items() if u == user and m - day < t <= m)
        )
        for user, m in minutes
    }


def test_rolling_cap_over_batches_and_restarts(spark, feed, tmp_path):
    calls = make_calls(seed=8)
    rng = random.Random(1)
    for part in chunks(calls, 5):
        rng.shuffle(part)
        feed.add(part)
        with spend.rocksdb_state(spark):
            rolling = spend.stream_rolling_cap(feed.stream(), 4, time_col="at", credit_col="credits")
            sinks.write_rows(
                rolling, str(tmp_path / "out"), str(tmp_path / "cp"), available_now=True
            ).awaitTermination()
    result = spark.read.schema(rolling.schema).parquet(str(tmp_path / "out"))
    rows = result.withColumn("minute", F.col("minute").cast("timestamp_ntz")).collect()
    released = max(at for _, _, _, at, _ in calls) - timedelta(minutes=45)
    expected = expected_rolling(calls, released)
    assert {(r.user_id, r.minute): r.rolling_credits for r in rows} == expected
    assert len(rows) == len(expected)
    assert {r.over_limit for r in rows} == {True, False}
    for r in rows:
        assert r.over_limit == (r.rolling_credits > 4)


def test_state_provider_is_put_back(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    with spend.rocksdb_state(spark):
        assert "RocksDB" in spark.conf.get(key)
    assert spark.conf.get(key, None) == before


def test_shared_folder_is_required():
    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        sinks.shared_folder(Session(), "x")
    Conf.get = lambda self, key, default=None: "/shared/"
    assert sinks.shared_folder(Session(), "x").startswith("/shared/x-")
