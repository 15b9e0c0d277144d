"""Streams of events against plain walks, over batches in disorder and restarts."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from spendlens.functions.tags import tag_value
from spendlens.operators import controls
from spendlens.streaming import events, shards, sinks, spend
from tests.test_streaming import SCHEMA, START, Feed, chunks, make_calls

DELAY = timedelta(minutes=45)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path / "in")


def drain(spark, feed, calls, build, folder, batches=4, seed=1):
    """Every batch is a new query on the same checkpoint; inside a batch calls are in no order."""
    rng = random.Random(seed)
    for part in chunks(calls, batches):
        rng.shuffle(part)
        feed.add(part)
        with spend.rocksdb_state(spark):
            found = sinks.drain_rows(build(feed.stream()), str(folder))
    times = [c for c, kind in found.dtypes if kind == "timestamp"]
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times}).collect()


def shifted(calls, by):
    return [(*c[:3], c[3] + by, c[4]) for c in calls]


def test_budget_events(spark, feed, tmp_path):
    """Calls around the turn of a month; 'a' reaches all steps, 'b' none, team-less calls belong to none."""
    calls = shifted(make_calls(seed=6), timedelta(days=29, hours=12))
    calls.append((9, "f", "team=a", calls[-1][3] + timedelta(days=40), Decimal("0.5")))
    limits = spark.createDataFrame([("a", 25), ("b", 100_000)], "scope string, credits bigint")
    scope = tag_value(F.col("query_tag"), "team")
    got = drain(spark, feed, calls, lambda s: events.stream_budget_events(s, limits, scope, "at", "credits"), tmp_path / "o")
    released = max(c[3] for c in calls) - DELAY
    want = set()
    for team, budget in (("a", 25), ("b", 100_000)):
        for month in (datetime(2024, 1, 1), datetime(2024, 2, 1)):
            after = month.replace(month=month.month + 1)
            mine = sorted((at, c) for _, _, tag, at, c in calls if tag == f"team={team}" and month <= at < after)
            total, steps = Decimal(0), [50, 75, 80, 90]
            for at, c in mine:
                total += c
                while steps and total * 100 >= budget * steps[0]:
                    want.add((team, month, "crossed", float(steps.pop(0)), at))
            if mine and after <= released:
                want.add((team, month, "closed", None, after))
    assert {(r.scope, r.month, r.event, r.threshold_pct, r["at"]) for r in got} == want and len(got) == len(want)
    assert {e[2] for e in want} == {"crossed", "closed"}
    # The same crossings as the batch report on the whole log.
    log = spark.createDataFrame(feed.given, SCHEMA)
    batch = controls.budget_burn(log, limits, scope, None, "at", "credits", months=None)
    known = {(r.scope, r.month, r.threshold_pct): r.crossed_at for r in batch.collect() if r.crossed_at}
    assert {k: v for k, v in known.items() if v <= released} == {
        (r.scope, r.month, r.threshold_pct): r["at"] for r in got if r.event == "crossed"
    }


def runs(steps, max_tokens, pause):
    """Events of each run, walked through in order."""
    out = []
    by_run = {}
    for run, at, tokens, done in steps:
        by_run.setdefault(run, {}).setdefault(at, []).append((tokens, done))
    released = max(at for _, at, _, _ in steps) - DELAY
    for run, instants in by_run.items():
        state = None
        for at, rows in sorted(instants.items()):
            if at > released:
                break
            if state and at - state["last"] > pause:
                out.append((run, "silent", state["last"] + pause, state["used"]))
                state = None
            state = state or {"start": at, "used": 0, "told": set()}
            state["used"] += sum(t for t, _ in rows)
            state["last"] = at
            for event, over in (("tokens", state["used"] > max_tokens), ("seconds", at - state["start"] > pause)):
                if over and event not in state["told"]:
                    state["told"].add(event)
                    out.append((run, event, at, state["used"]))
            if any(d for _, d in rows):
                state = None
        if state and state["last"] + pause < released - timedelta(milliseconds=1):
            out.append((run, "silent", state["last"] + pause, state["used"]))
    return sorted(out)


class StepFeed(Feed):
    SCHEMA = "run bigint, at timestamp_ntz, tokens bigint, done boolean"

    def add(self, steps):
        df = self.spark.createDataFrame(steps, self.SCHEMA)
        df.coalesce(1).write.mode("append").parquet(self.folder)

    def stream(self):
        return spend.read_calls(self.spark, self.folder, self.spark.createDataFrame([], self.SCHEMA).schema)


def test_runs_that_break_their_budget_or_fall_silent(spark, tmp_path):
    rng = random.Random(4)
    steps = []
    for run in range(40):
        at = START + timedelta(seconds=rng.randrange(20_000))
        for i in range(rng.randrange(1, 12)):
            at += timedelta(seconds=rng.choice([5, 20, 60, 119, 120, 121, 500]))
            steps.append((run, at, rng.randrange(400), rng.random() < 0.1))
            if rng.random() < 0.1:
                steps.append((run, at, 10, None))
    steps.append((99, START + timedelta(days=1), 1, False))
    steps.sort(key=lambda s: s[1])
    got = drain(
        spark, StepFeed(spark, tmp_path / "in"), steps,
        lambda s: events.stream_run_budget(s, "run", "at", done=F.col("done"), max_tokens=1000), tmp_path / "o",
    )
    want = runs(steps, 1000, timedelta(seconds=120))
    assert sorted((r.run, r.event, r["at"], r.tokens_used) for r in got) == want
    assert {e for _, e, _, _ in want} == {"tokens", "seconds", "silent"}


CHANGE = "user_id bigint, credits decimal(18,9), valid_from timestamp_ntz, changed_at timestamp_ntz"


def test_limits_that_change_while_the_stream_runs(spark, feed, tmp_path):
    calls = make_calls(seed=8)
    minute = lambda m: START + timedelta(minutes=m)
    changes = [
        (1, Decimal(2), minute(0), minute(10)),
        (1, Decimal(9), minute(1500), minute(600)),
        (1, None, minute(3000), minute(2000)),
        (2, Decimal("0.5"), minute(2500), minute(2700)),  # known only after it began
        (2, Decimal("0.7"), minute(2500), minute(2600)),  # set earlier for the same time
        (7, Decimal(1), minute(5), minute(5)),
    ]
    folder = str(tmp_path / "changes")
    schema = spark.createDataFrame([], CHANGE).schema
    ordered = sorted(changes, key=lambda c: c[3])
    spark.createDataFrame(ordered[:1], CHANGE).write.parquet(folder)
    rest = ordered[1:]

    def build(stream):
        # A change is there by the time the calls of its minute are.
        newest = feed.given[-1][3] if feed.given else START
        newest = max([newest, *(c[3] for c in feed.given)])
        while rest and rest[0][3] <= newest:
            spark.createDataFrame([rest.pop(0)], CHANGE).write.mode("append").parquet(folder)
        told = spend.read_calls(spark, folder, schema)
        return events.stream_rolling_cap_limits(stream, told, 4, time_col="at", credit_col="credits")

    got = drain(spark, feed, calls, build, tmp_path / "o", batches=5)
    released = max(c[3] for c in calls) - DELAY
    minutes = {}
    for user, _, _, at, c in calls:
        key = user, at.replace(second=0)
        minutes[key] = minutes.get(key, Decimal(0)) + c
    want = {}
    for (user, m), _ in minutes.items():
        if m + timedelta(minutes=1) > released:
            continue
        rolling = sum(c for (u, t), c in minutes.items() if u == user and m - timedelta(hours=24) < t <= m)
        known = [c for c in changes if c[0] == user and c[2] <= m and c[3].replace(second=0) <= m]
        own = max(known, key=lambda c: (c[2], c[3]))[1] if known else None
        cap = 4 if own is None else own
        want[user, m] = (float(rolling), float(cap), rolling > cap)
    assert {(r.user_id, r.minute): (r.rolling_credits, r.credit_limit, r.over_limit) for r in got} == want
    assert len(got) == len(want) and {c for _, c, _ in want.values()} == {2, 9, 4, 0.7, 0.5}


def test_many_runs_share_calls_and_timers(spark, tmp_path):
    """What a batch costs in calls follows the shards, not the runs."""
    steps = [(run, START + timedelta(seconds=run % 60), run % 7, False) for run in range(3 * shards.SHARDS)]
    steps.append((-1, START + timedelta(days=1), 1, False))
    feed = StepFeed(spark, tmp_path / "in")
    feed.add(steps)
    with spend.rocksdb_state(spark):
        found = events.stream_run_budget(feed.stream(), "run", "at", max_tokens=5)
        query = sinks.write_rows(found, str(tmp_path / "o"), str(tmp_path / "c"), available_now=True)
        query.awaitTermination()
    timers = [
        int(s["customMetrics"].get("numRegisteredTimers", 0)) for p in query.recentProgress for s in p["stateOperators"]
    ]
    assert 0 < sum(timers) <= shards.SHARDS
    rows = spark.read.schema(found.schema).parquet(str(tmp_path / "o"))
    assert sorted((r.run, r.event) for r in rows.collect()) == sorted(
        [(r, "silent") for r, *_ in steps[:-1]] + [(r, "tokens") for r, _, t, _ in steps if t > 5]
    )


def test_steps_without_a_run_id_are_one_run_in_order_of_time(spark, tmp_path):
    steps = [(None, START + timedelta(seconds=i), 10, False) for i in range(200)]
    steps.append((1, START + timedelta(days=1), 1, False))
    got = drain(
        spark, StepFeed(spark, tmp_path / "in"), steps,
        lambda s: events.stream_run_budget(s, "run", "at", max_tokens=1000), tmp_path / "o", batches=2,
    )
    assert sorted((r.event, r["at"], r.tokens_used) for r in got) == [
        ("seconds", START + timedelta(seconds=121), 1220),
        ("silent", START + timedelta(seconds=199 + 120), 2000),
        ("tokens", START + timedelta(seconds=100), 1010),
    ]


def test_limits_of_many_users_share_calls_and_timers(spark, tmp_path):
    """Users of a shard keep their own sums and limits; there are no more timers than shards."""
    users = 2 * shards.SHARDS
    last = START + timedelta(hours=3)
    calls = [(u, START + timedelta(minutes=m), Decimal(u % 5 + 1)) for u in range(users) for m in (0, 60)]
    feed = spark.createDataFrame([*calls, (-1, last, Decimal(1))], "user_id bigint, at timestamp_ntz, credits decimal(18,9)")
    feed.coalesce(1).write.parquet(str(tmp_path / "in"))
    told = [(u, Decimal(u % 3), START, START) for u in range(0, users, 2)]
    spark.createDataFrame(told, CHANGE).coalesce(1).write.parquet(str(tmp_path / "told"))
    read = lambda name, schema: spend.read_calls(spark, str(tmp_path / name), schema)
    changes = spark.createDataFrame([], CHANGE).schema
    with spend.rocksdb_state(spark):
        found = events.stream_rolling_cap_limits(
            read("in", feed.schema), read("told", changes), 4, time_col="at", credit_col="credits"
        )
        query = sinks.write_rows(found, str(tmp_path / "o"), str(tmp_path / "c"), available_now=True)
        query.awaitTermination()
    timers = [
        int(s["customMetrics"].get("numRegisteredTimers", 0)) for p in query.recentProgress for s in p["stateOperators"]
    ]
    assert 0 < sum(timers) <= shards.SHARDS
    rows = spark.read.schema(found.schema).parquet(str(tmp_path / "o")).withColumn("minute", F.col("minute").cast("timestamp_ntz"))
    assert sorted((r.user_id, r.minute, r.rolling_credits, r.credit_limit) for r in rows.collect()) == sorted(
        (u, at, float((u % 5 + 1) * (1 if at == START else 2)), float(u % 3 if u % 2 == 0 else 4)) for u, at, _ in calls
    )
