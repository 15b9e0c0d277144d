"""Streams that say when something happened: budget thresholds, silent runs, changing caps.

Rows are first put together per instant or minute and released once the watermark has
passed them. From there on they come in order of time, so the operators below keep a
few numbers per key and what they emit does not depend on how rows were cut into
batches. A timer ends each key's state; runs and caps share theirs by shard. All are for
append mode and are started inside ``spend.rocksdb_state``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from spendlens.functions.money import credit, dec
from spendlens.operators.controls import BUDGET_THRESHOLDS, CAP_HOURS, DAILY_LIMIT, RUN_SECONDS, RUN_TOKENS
from spendlens.streaming.shards import Due, Lapse, Walk, walk_keys
from spendlens.streaming.spend import LOG_DELAY, timed

_NANO = 1_000_000_000

_EVENTS = "scope string, month bigint, event string, pct_x100 bigint, at bigint, nano bigint, budget bigint"


def _nano(value: Column) -> Column:
    return (value * dec(_NANO)).cast("bigint")


def _from_nano(name: str) -> Column:
    return (F.col(name).cast("decimal(28,0)") * dec("0.000000001")).cast("double")


def _budget_processor(thresholds: Sequence[int]) -> StatefulProcessor:
    """Events of one scope and month; thresholds are hundredths of a percent, ascending.

    State is the running sum and how many thresholds it has reached.
    """
    steps = list(thresholds)

    class Budget(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.spent = handle.getValueState("spent", "nano bigint, reached int, budget bigint, ends bigint")

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            new = pd.concat(list(rows)).sort_values("at")
            total, reached = self.spent.get()[:2] if self.spent.exists() else (0, 0)
            budget, ends = int(new["budget"].iloc[0]), int(new["ends"].iloc[0])
            out = []
            for at, nano in zip(new["at"].tolist(), new["nano"].tolist()):
                total += nano
                while reached < len(steps) and total * 10_000 >= budget * steps[reached]:
                    out.append((*key, "crossed", steps[reached], at, total, budget))
                    reached += 1
            self.spent.update((total, reached, budget, ends))
            self.handle.registerTimer(ends // 1000)
            yield _frame(out)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            total, _, budget, ends = self.spent.get()
            self.spent.clear()
            yield _frame([(*key, "closed", None, ends, total, budget)])

        def close(self) -> None:
            pass

    columns = [f.split()[0] for f in _EVENTS.split(", ")]

    def _frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=columns).astype({"pct_x100": "Int64"})

    return Budget()


def stream_budget_events(
    calls,
    limits,
    scope: Column,
    time_col="usage_time",
    credit_col="token_credits",
    thresholds: Sequence[float] = BUDGET_THRESHOLDS,
    delay=LOG_DELAY,
) -> DataFrame:
    """When each budget first reached each threshold, and the end of each month.

    One row ``crossed`` per scope, month and threshold at the time of the call that
    reached it, and one row ``closed`` with the month's spend once the watermark has
    passed its end; then the state is gone. Calls later than ``delay`` drop, so unlike
    ``stream_budget_burn`` this acts in time and does not settle accounts. Calls of
    scopes without a limit, and calls without a time, are left out.
    """
    budgets = limits.select("scope", _nano(credit("credits")).alias("budget"))
    spent = timed(calls, time_col, delay).select("_at", scope.alias("scope"), credit(credit_col).alias("c"))
    month = F.date_trunc("month", F.col("_at"))
    instants = (
        spent.join(budgets, "scope")
        .groupBy("_at", "scope", "budget")
        .agg(F.sum("c").alias("c"))
        .select(
            "_at", "scope", "budget",
            F.unix_micros(month).alias("month"),
            F.unix_micros(month + F.expr("INTERVAL 1 MONTH")).alias("ends"),
            F.unix_micros("_at").alias("at"),
            F.coalesce(_nano(F.col("c")), F.lit(0).cast("bigint")).alias("nano"),
        )
    )
    found = instants.groupBy("scope", "month").transformWithStateInPandas(
        statefulProcessor=_budget_processor([round(100 * p) for p in sorted(thresholds)]),
        outputStructType=_EVENTS,
        outputMode="append",
        timeMode="eventtime",
    )
    return found.select(
        "scope",
        F.timestamp_micros("month").alias("month"),
        "event",
        (F.col("pct_x100") / 100).alias("threshold_pct"),
        F.timestamp_micros("at").alias("at"),
        _from_nano("nano").alias("spend"),
        _from_nano("budget").alias("budget"),
    )


def _run_steps(max_tokens: int, max_micros: int) -> tuple[Walk, Due, Lapse]:
    """Events of one run. State is its start, last step, tokens, and what was reported."""

    def silent(state):
        started, last, used, _ = state
        return "silent", last + max_micros, used, last - started

    def walk(state, steps):
        out = []
        for at, tokens, done in steps:
            if state and at - state[1] > max_micros:
                out.append(silent(state))
                state = None
            started, _, used, told = state or (at, at, 0, 0)
            used += tokens
            if used > max_tokens and not told & 1:
                out.append(("tokens", at, used, at - started))
                told |= 1
            if at - started > max_micros and not told & 2:
                out.append(("seconds", at, used, at - started))
                told |= 2
            state = None if done else (started, at, used, told)
        return state, out

    def due(state):
        return (state[1] + max_micros) // 1000 + 1

    def lapse(state):
        return None, [silent(state)]

    return walk, due, lapse


def stream_run_budget(
    steps,
    run="conv_id",
    time_col="event_timestamp",
    tokens="tokens",
    done: Column | None = None,
    max_tokens=RUN_TOKENS,
    max_seconds=RUN_SECONDS,
    delay=LOG_DELAY,
) -> DataFrame:
    """Runs that break their budget, as soon as that is certain.

    ``tokens`` and ``seconds`` name the step at which a run first was over its token or
    time budget. ``silent`` is a run that gave no step for ``max_seconds`` and had not
    said it was ``done``: no row tells of it, so a timer does. A step after that
    begins a new run. Steps of one instant count together.
    """
    flag = F.lit(False) if done is None else F.coalesce(done, F.lit(False))
    instants = (
        timed(steps, time_col, delay)
        .select("_at", F.col(run).alias("run"), F.col(tokens).cast("bigint").alias("t"), flag.alias("d"))
        .groupBy("_at", "run")
        .agg(F.coalesce(F.sum("t"), F.lit(0)).alias("tokens"), F.max("d").alias("done"))
        .select("_at", "run", F.unix_micros("_at").alias("at"), "tokens", "done")
    )
    found = walk_keys(
        instants, ["run"], "_at", ["at", "tokens", "done"],
        "started bigint, last bigint, tokens bigint, told int",
        "event string, at bigint, tokens bigint, elapsed bigint",
        *_run_steps(max_tokens, round(max_seconds * 1_000_000)),
    )
    return found.select(
        F.col("run").alias(run), "event", F.timestamp_micros("at").alias("at"),
        F.col("tokens").alias("tokens_used"), (F.col("elapsed") / 1_000_000).alias("seconds_used"),
    )


def _cap_minutes(hours: int, default: int) -> tuple[Walk, Due, Lapse]:
    """Rolling sums of one key against the limit in force at each minute.

    State is one sum per minute of the last ``hours``, and the limits that hold or will.
    """
    span = hours * 3_600_000_000

    def left(held, limits):
        if not held and not limits:
            return None
        return tuple([x[i] for x in rows] for rows, n in ((held, 2), (limits, 3)) for i in range(n))

    def walk(state, rows):
        held, limits = ([*zip(*state[:2])], [*zip(*state[2:])]) if state else ([], [])
        total, first, out = sum(n for _, n in held), 0, []
        for minute, nano, calls, changes in rows:
            if changes:
                # Of two limits for one time the one set later holds.
                limits = sorted([*limits, *[(int(c["since"]), int(c["said"]), c["nano"]) for c in changes]],
                                key=lambda x: x[:2])
            while len(limits) > 1 and limits[1][0] <= minute:
                limits.pop(0)
            if not calls:
                continue
            held.append((minute, nano))
            total += nano
            while held[first][0] <= minute - span:
                total -= held[first][1]
                first += 1
            own = limits[0][2] if limits and limits[0][0] <= minute else None
            out.append((minute, calls, total, default if own is None else own))
        return left(held[first:], limits), out

    def due(state):
        return (state[0][-1] + span) // 1000 if state[0] else None

    def lapse(state):
        return left([], [*zip(*state[2:])]), []

    return walk, due, lapse


def stream_rolling_cap_limits(
    calls,
    changes,
    limit=DAILY_LIMIT,
    keys: Sequence[str] = ("user_id",),
    time_col="event_timestamp",
    credit_col="total_credits",
    hours=CAP_HOURS,
    delay=LOG_DELAY,
) -> DataFrame:
    """``stream_rolling_cap`` with limits that change while it runs.

    ``changes`` is a second stream: the keys, ``credits`` (NULL takes an own limit
    away), ``valid_from`` and ``changed_at``. A minute is held against the limit valid at its
    start, among those that were set by the end of it. Both streams share one watermark,
    since a limit that nobody changes must not hold up the calls.
    """
    none = F.lit(None).cast("struct<since:bigint,said:bigint,nano:bigint>")
    spent = calls.select(
        *keys, F.col(time_col).cast("timestamp").alias("_at"), credit(credit_col).alias("c"),
        F.lit(1).alias("n"), none.alias("change"),
    )
    told = changes.select(
        *keys, F.col("changed_at").cast("timestamp").alias("_at"), F.lit(None).cast("decimal(18,9)").alias("c"),
        F.lit(0).alias("n"),
        F.struct(
            F.unix_micros(F.col("valid_from").cast("timestamp")).alias("since"),
            F.unix_micros(F.col("changed_at").cast("timestamp")).alias("said"),
            _nano(credit("credits")).alias("nano"),
        ).alias("change"),
    )
    minutes = (
        spent.unionByName(told)
        .withWatermark("_at", delay)
        .groupBy(F.window("_at", "1 minute").alias("w"), *keys)
        .agg(F.sum("c").alias("c"), F.sum("n").alias("calls"), F.collect_list("change").alias("changes"))
        .select(
            *keys, F.window_time("w").alias("released"), F.unix_micros("w.start").alias("minute"),
            F.coalesce(_nano(F.col("c")), F.lit(0).cast("bigint")).alias("nano"), "calls", "changes",
        )
    )
    rolled = walk_keys(
        minutes, keys, "released", ["minute", "nano", "calls", "changes"],
        "minutes array<bigint>, nanos array<bigint>, since array<bigint>, said array<bigint>, limits array<bigint>",
        "minute bigint, calls bigint, rolling_nano bigint, cap bigint",
        *_cap_minutes(hours, int(limit * _NANO)),
    )
    return rolled.select(
        *keys,
        F.timestamp_micros("minute").alias("minute"),
        "calls",
        _from_nano("rolling_nano").alias("rolling_credits"),
        _from_nano("cap").alias("credit_limit"),
        (F.col("rolling_nano") > F.col("cap")).alias("over_limit"),
    )
