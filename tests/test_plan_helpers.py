"""Blocked running totals, rolling totals, hot-key lookup and budget drill-down
against plain Python, with one key that owns much of the rows."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from spendlens.operators import controls
from spendlens.plans.running import rolling_totals, running_totals
from spendlens.plans.skew import hot_keys, lookup

START = datetime(2024, 1, 1)


def skewed_calls(n, seed, refunds=False):
    """Calls of which one user makes about half, with repeated times."""
    rng = random.Random(seed)
    calls = []
    for i in range(n):
        user = rng.choice([None, 1, 1, 1, 1, 2, 3])
        at = START + timedelta(minutes=rng.randrange(0, 6 * 24 * 60, 7))
        nano = rng.randrange(-400 if refunds else 0, 1000)
        calls.append((i, user, at, Decimal(nano) / 1000))
    return calls


@pytest.fixture(scope="module")
def calls(spark):
    given = skewed_calls(600, 7)
    schema = "id bigint, user_id bigint, at timestamp_ntz, credits decimal(18,9)"
    return given, spark.createDataFrame(given, schema)


@pytest.mark.parametrize("block", ["1 minute", "6 hours", "30 days"])
def test_running_totals(calls, block):
    given, df = calls
    got = running_totals(df, ["user_id"], "at", ["credits"], F.window("at", block).start)
    expected = {
        i: sum(c for _, u, t, c in given if u == user and t <= at) for i, user, at, _ in given
    }
    assert {r.id: r.running_credits for r in got.collect()} == expected


@pytest.mark.parametrize("block", ["5 minutes", "1 day"])
def test_rolling_totals(calls, block):
    given, df = calls
    got = rolling_totals(df, ["user_id"], "at", "credits", hours=24, block=block)
    day = timedelta(hours=24)
    expected = {
        i: sum(c for _, u, t, c in given if u == user and at - day <= t <= at)
        for i, user, at, _ in given
    }
    assert {r.id: r.rolling_credits for r in got.collect()} == expected
    assert got.columns == [*df.columns, "rolling_credits"]


def test_lookup(spark):
    keys = ["hot"] * 300 + [f"k{i % 40}" for i in range(200)] + [None] * 20 + ["absent"] * 5
    rows = spark.createDataFrame(list(enumerate(keys)), "id bigint, key string")
    values = (
        rows.where("key <> 'absent'")
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("value", F.concat(F.lit("v-"), "key"))
    )
    hot = hot_keys(values, "key", "n")
    # Of the 520 counted rows "hot" has 300 of 8 even shares of 65.
    assert [(r.key, r.parts) for r in hot.collect()] == [("hot", 5)]
    got = lookup(rows, values, "key", hot, "id")
    answers = {r.id: (r.n, r.value) for r in got.collect()}
    assert len(answers) == len(keys) and got.count() == len(keys)
    for i, key in enumerate(keys):
        if key in (None, "absent"):
            assert answers[i] == (None, None)
        else:
            assert answers[i] == (keys.count(key), f"v-{key}")


def test_hot_keys_are_fewer_than_partitions(spark):
    groups = spark.range(100).selectExpr("id AS key", "CAST(if(id < 20, 1000, 1) AS bigint) AS n")
    assert hot_keys(groups, "key", "n").count() == 0  # 20 equal keys: none has an eighth
    groups = spark.range(100).selectExpr("id AS key", "CAST(if(id < 7, 1000, 1) AS bigint) AS n")
    assert {r.key: r.parts for r in hot_keys(groups, "key", "n").collect()} == dict.fromkeys(range(7), 2)


def test_rolling_totals_keep_rows_without_a_time(spark):
    rows = [(1, "2024-01-01 00:00:00", 1), (1, None, 5), (None, "2024-01-01 00:00:00", 2), (None, None, 7),
            (1, "2024-01-01 00:00:00", 1), (1, "2024-01-02 00:00:00", 3), (1, "2024-01-02 00:00:01", 4)]
    df = spark.createDataFrame(rows, "user_id bigint, at string, c int").selectExpr(
        "user_id", "CAST(at AS timestamp_ntz) AS at", "CAST(c AS decimal(18,9)) AS c")
    got = rolling_totals(df, ["user_id"], "at", "c")
    assert sorted(((r.user_id or 0), int(r.c), r.rolling_c and int(r.rolling_c)) for r in got.collect()) == [
        (0, 2, 2), (0, 7, None), (1, 1, 2), (1, 1, 2), (1, 3, 5), (1, 4, 7), (1, 5, None)]


@pytest.mark.parametrize("refunds", [False, True])
def test_budget_burn(spark, refunds):
    given = skewed_calls(500, 11, refunds)
    df = spark.createDataFrame(
        [(u, at, c) for _, u, at, c in given],
        "user_id bigint, usage_time timestamp_ntz, token_credits decimal(18,9)",
    )
    budget = 30
    limits = spark.createDataFrame([("1", budget), ("3", 1_000)], "scope string, credits bigint")
    thresholds = (10, 50, 75, 90, 100)
    burn = controls.budget_burn(
        df, limits, F.col("user_id").cast("string"), thresholds=thresholds
    )
    got = {(r.scope, r.threshold_pct): r.crossed_at for r in burn.collect()}
    for scope, credits in (("1", budget), ("3", 1_000)):
        own = [(at, c) for _, u, at, c in given if str(u) == scope]
        for pct in thresholds:
            target = Decimal(credits) * pct / 100
            crossing = [
                at for at, _ in own if sum(c for t, c in own if t <= at) >= target
            ]
            assert got[(scope, float(pct))] == (min(crossing) if crossing else None)


@pytest.mark.parametrize("block_steps", [1, 4, 1000])
def test_run_budget(spark, block_steps):
    rng = random.Random(3)
    steps = [(rng.choice([1, 1, 1, 2, 3]), rng.randrange(40), rng.randrange(50), rng.randrange(9)) for _ in range(300)]
    df = spark.createDataFrame(steps, "conv_id bigint, turn bigint, tokens bigint, seconds bigint")
    got = {
        r.conv_id: (r.first_step_over, r.tokens_used, r.seconds_used, r.reason)
        for r in controls.run_budget(
            df, max_tokens=900, max_seconds=100, block_steps=block_steps
        ).collect()
    }
    expected = {}
    for run in {s[0] for s in steps}:
        for turn in sorted({s[1] for s in steps if s[0] == run}):
            used = [s for s in steps if s[0] == run and s[1] <= turn]
            tokens, seconds = sum(s[2] for s in used), sum(s[3] for s in used)
            if tokens > 900 or seconds > 100:
                why = [w for w, over in (("tokens", tokens > 900), ("seconds", seconds > 100)) if over]
                expected[run] = (turn, tokens, seconds, " and ".join(why))
                break
    assert got == expected and expected


def test_cap_overrides_and_surfaces(spark):
    rows = [
        ("cli", 1, 1, "a", START, Decimal("6")),
        ("cli", 2, 1, "a", START + timedelta(hours=24), Decimal("6")),
        ("cli", 3, 1, "a", START + timedelta(hours=48, microseconds=1), Decimal("6")),
        ("web", 4, 1, "a", START, Decimal("6")),
        ("cli", 5, 2, "b", START, Decimal("6")),
    ]
    calls = spark.createDataFrame(
        rows,
        "surface string, request_id bigint, user_id bigint, user_name string, "
        "event_timestamp timestamp_ntz, total_credits decimal(18,9)",
    )
    overrides = spark.createDataFrame([(2, 5)], "user_id bigint, credits bigint")
    capped = {
        r.request_id: (int(r.rolling_credits), r.over_limit)
        for r in controls.rolling_cap(calls, 10, overrides).collect()
    }
    assert capped == {
        1: (6, False),
        2: (12, True),
        3: (6, False),
        4: (6, False),
        5: (6, True),
    }
