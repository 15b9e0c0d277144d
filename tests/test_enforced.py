"""The enforced cap against a plain walk over each user's calls."""

import random
from collections import defaultdict
from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from spendlens.operators import controls
from spendlens.plans import episodes

START = datetime(2024, 1, 1)
DAY = timedelta(hours=24)
SCHEMA = "request_id bigint, user_id bigint, surface string, event_timestamp timestamp_ntz, total_credits decimal(18,9)"


def walk(calls, cap):
    """Per call its counted rolling spend and whether it was blocked."""
    instants = defaultdict(lambda: defaultdict(Decimal))
    for _, user, surface, at, credits in calls:
        if at is not None:
            instants[user, surface][at] += credits or 0
    decided = {}
    for key, sums in instants.items():
        counted = []
        for at, credits in sorted(sums.items()):
            counted = [(t, c) for t, c in counted if t >= at - DAY]
            spent = sum(c for _, c in counted)
            blocked = credits > 0 and spent + credits > cap(key[0])
            if not blocked:
                counted.append((at, credits))
                spent += credits
            decided[(*key, at)] = (spent, blocked)
    return sorted(
        (i, *((None, None) if at is None else decided[user, surface, at])) for i, user, surface, at, _ in calls
    )


def made(rng, n, days, users, refunds=False):
    """Calls in whole minutes, a third of them by user 1, so instants repeat and gaps of exactly a day occur."""
    rows = []
    for i in range(n):
        user = 1 if rng.random() < 0.33 else rng.choice(users)
        at = START + timedelta(minutes=rng.randrange(0, days * 1440, 20))
        credits = Decimal(rng.randrange(-50 if refunds else 0, 300)) / 100
        rows.append((i, user, rng.choice(["cli", "web"]), at, credits))
    return rows


def enforced(spark, calls, limit, overrides=None, **window):
    df = controls.rolling_cap_enforced(spark.createDataFrame(calls, SCHEMA), limit, overrides, **window)
    return sorted((r.request_id, r.rolling_credits, r.blocked) for r in df.collect())


@pytest.mark.parametrize("seed, limit, refunds", [(1, 4, False), (2, 9, False), (3, 1, False), (4, 5, True)])
def test_against_a_walk(spark, seed, limit, refunds):
    rng = random.Random(seed)
    calls = made(rng, 900, 30, [2, 3, 4, None], refunds)
    calls += [(1000, 2, "cli", None, Decimal(5)), (1001, None, None, START, Decimal(1)), (1002, 2, "cli", START, None)]
    overrides = spark.createDataFrame([(3, Decimal("2.5"))], "user_id bigint, credits decimal(18,9)")
    want = walk(calls, lambda user: Decimal("2.5") if user == 3 else limit)
    assert enforced(spark, calls, limit, overrides) == want
    blocked = [b for _, _, b in want]
    assert True in blocked and False in blocked


def test_equals_the_audit_until_the_first_block(spark):
    calls = made(random.Random(7), 400, 40, [2, 3])
    df = spark.createDataFrame(calls, SCHEMA)
    audit = {r.request_id: r for r in controls.rolling_cap(df, 5).collect()}
    first = defaultdict(lambda: datetime.max)
    rows = controls.rolling_cap_enforced(df, 5).collect()
    for r in rows:
        if r.blocked:
            first[r.user_id, r.surface] = min(first[r.user_id, r.surface], r.event_timestamp)
    for r in rows:
        a = audit[r.request_id]
        assert a.over_limit or not r.blocked
        if r.event_timestamp < first[r.user_id, r.surface]:
            assert (a.rolling_credits, a.over_limit) == (r.rolling_credits, False)


def test_a_window_keeps_the_decisions(spark):
    calls = made(random.Random(9), 500, 30, [2, 3])
    whole = [r for r in enforced(spark, calls, 4)]
    times = {i: at for i, _, _, at, _ in calls}
    end = START + timedelta(days=20)
    part = enforced(spark, calls, 4, as_of=str(end), days=5)
    assert part == [r for r in whole if end - timedelta(days=5) <= times[r[0]] <= end]


def test_episodes_are_cut_at_gaps_longer_than_the_window(spark):
    at = [0, 60, 24 * 60 + 60, 48 * 60 + 61, 200 * 60]
    rows = [(1, START + timedelta(minutes=m)) for m in at] + [(2, START)]
    over = spark.createDataFrame(rows, "user_id bigint, _at timestamp_ntz")
    found = sorted((r.user_id, r._start, r._end) for r in episodes.episodes(over, ["user_id"], 24).collect())
    minute = lambda m: START + timedelta(minutes=m)
    assert found == [
        (1, minute(0), minute(24 * 60 + 60)), (1, minute(48 * 60 + 61), minute(48 * 60 + 61)),
        (1, minute(200 * 60), minute(200 * 60)), (2, START, START),
    ]


def test_only_episodes_are_folded(spark, monkeypatch):
    rng = random.Random(11)
    calm = [(i, 5, "cli", START + timedelta(minutes=i), Decimal("0.001")) for i in range(500)]
    burst = [(1000 + i, 5, "cli", START + timedelta(days=9, minutes=i), Decimal(1)) for i in range(30)]
    rng.shuffle(calm)
    seen = spark.sparkContext.accumulator(0)
    fold = episodes._fold

    def counting(n_keys, hours):
        inner = fold(n_keys, hours)

        def run(batches):
            def counted():
                for b in batches:
                    seen.add(b.num_rows)
                    yield b

            yield from inner(counted())

        return run

    monkeypatch.setattr(episodes, "_fold", counting)
    got = enforced(spark, calm + burst, 10)
    assert [b for _, _, b in got] == [False] * 510 + [True] * 20
    # The fold may be planned twice, for the decisions and for what counted.
    assert seen.value in (30, 60)


def test_empty_log(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert controls.rolling_cap_enforced(empty, 5).count() == 0
