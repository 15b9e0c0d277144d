"""Spend controls worked out from the logs: caps, budgets, allowlists, tags.

These report which calls, runs or budgets break a rule. Blocking the call is
the host's part.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendlens.functions.money import credit, dec, quotient, resummed
from spendlens.functions.tags import tag_value
from spendlens.functions.time import literal_like, month_start, parse_as_of, recent, truncated
from spendlens.plans.episodes import blocked_instants
from spendlens.plans.running import instant_totals, meet_instants, rolling_totals, running_totals

# Tag keys every call should carry.
REQUIRED_TAG_KEYS = ("team", "project", "env")

# Budget notification steps in percent.
BUDGET_THRESHOLDS = (50, 75, 80, 90)

# Token and time budget of one agent run.
RUN_TOKENS = 50_000
RUN_SECONDS = 120

# Daily credit limit per user and surface, and its window.
DAILY_LIMIT = 20
CAP_HOURS = 24


def _window(df: DataFrame, time_col: str, as_of, days) -> DataFrame:
    """The rows of a window; without ``as_of`` all of them."""
    return df if as_of is None else recent(df, time_col, as_of, days=days)


def surfaces(**usage: DataFrame) -> DataFrame:
    """Union of assistant logs with the surface name in its own column."""
    columns = ("request_id", "user_id", "user_name", "event_timestamp", "total_credits")
    parts = [
        df.select(F.lit(name).alias("surface"), *columns) for name, df in usage.items()
    ]
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part)
    return both


def rolling_cap(
    calls,
    limit=DAILY_LIMIT,
    overrides: DataFrame | None = None,
    hours=CAP_HOURS,
    keys: Sequence[str] = ("user_id", "surface"),
    time_col="event_timestamp",
    credit_col="total_credits",
    block="1 minute",
    as_of=None,
    days=None,
) -> DataFrame:
    """Every call with its user's rolling spend, limit and an over-limit flag.

    The window rolls over the ``hours`` before each call, and surfaces count
    apart. ``overrides`` (user_id, credits, and surface where limits differ by
    surface) has one row per exception. This audits what was spent: a call over
    the limit still counts towards later ones. A call without a time has no rolling
    spend and no flag. With ``as_of`` and ``days`` only the calls of that window are
    returned, and the calls of the ``hours`` before it still count.
    """
    if as_of is not None:
        before = None if days is None else hours
        calls = recent(calls, time_col, as_of, days=days, hours=before)
    spent = calls.withColumn(credit_col, credit(credit_col))
    rolled = rolling_totals(spent, keys, time_col, credit_col, hours, block)
    cap = dec(limit).cast("decimal(18,9)")
    if overrides is not None:
        on = [k for k in keys if k in overrides.columns]
        caps = overrides.select(*on, F.col("credits").cast("decimal(18,9)").alias("_cap"))
        rolled = rolled.join(caps, on, "left")
        cap = F.coalesce("_cap", cap)
    rolling = F.col(f"rolling_{credit_col}")
    if as_of is not None and days is not None:
        start = parse_as_of(as_of) - timedelta(days=days)
        rolled = rolled.where(
            F.col(time_col) >= literal_like(start, calls.schema[time_col].dataType)
        )
    return rolled.select(
        *calls.columns,
        rolling.alias("rolling_credits"),
        cap.alias("credit_limit"),
        (rolling > cap).alias("over_limit"),
    )


def rolling_cap_enforced(
    calls,
    limit=DAILY_LIMIT,
    overrides: DataFrame | None = None,
    hours=CAP_HOURS,
    keys: Sequence[str] = ("user_id", "surface"),
    time_col="event_timestamp",
    credit_col="total_credits",
    block="1 minute",
    as_of=None,
    days=None,
) -> DataFrame:
    """Every call with what counted of its user's spend, the limit, and whether it was blocked.

    As ``rolling_cap``, but a blocked call does not count towards later ones. A call is
    blocked when it would bring the spend that counted in the ``hours`` before it over
    the limit, so a user at the limit is blocked until enough of it is ``hours`` old. Calls
    of one instant stand or fall together, as they count together in the audit; refunds
    always count. A call without a time is neither counted nor blocked (NULL).

    Decisions hang on all earlier ones, so with ``as_of`` and ``days`` all calls up to
    ``as_of`` count and those of the window are returned.
    """
    if as_of is not None:
        calls = recent(calls, time_col, as_of)
    spent = calls.withColumn(credit_col, credit(credit_col))
    known = spent.withColumn(credit_col, F.coalesce(credit_col, dec(0)).cast("decimal(18,9)"))
    totals = instant_totals(known, keys, time_col, credit_col, hours, block)
    cap = dec(limit).cast("decimal(18,9)")
    if overrides is not None:
        on = [k for k in keys if k in overrides.columns]
        caps = overrides.select(*on, F.col("credits").cast("decimal(18,9)").alias("_own_cap"))
        totals, cap = totals.join(caps, on, "left"), F.coalesce("_own_cap", cap)
    totals = totals.select(*keys, "_at", "_change", "_rolling", cap.alias("_cap"))
    stopped = blocked_instants(totals, keys, hours).withColumn("_stopped", F.lit(True))
    # What counted is a rolling total again, over instants whose blocked spend is zero.
    decided = totals.select(*keys, "_at", "_change", "_cap").join(
        stopped.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_at").alias("_when"), "_stopped"),
        _same_instant(keys), "left",
    ).select(
        *keys, F.col("_at").alias("_when"), "_cap", F.coalesce("_stopped", F.lit(False)).alias("_stopped"),
        F.when(F.col("_stopped"), dec(0)).otherwise(F.col("_change")).cast("decimal(28,9)").alias("_counted"),
    )
    counted = rolling_totals(decided, keys, "_when", "_counted", hours, block)
    met = meet_instants(spent, keys, time_col, counted.drop("_counted").withColumnRenamed("_when", "_at"))
    if as_of is not None and days is not None:
        start = parse_as_of(as_of) - timedelta(days=days)
        met = met.where(F.col(time_col) >= literal_like(start, calls.schema[time_col].dataType))
    return met.select(
        *calls.columns,
        F.col("rolling__counted").alias("rolling_credits"),
        F.col("_cap").alias("credit_limit"),
        F.col("_stopped").alias("blocked"),
    )


def _same_instant(keys: Sequence[str]) -> Column:
    same = F.col("_at") == F.col("_when")
    for key in keys:
        same &= F.col(key).eqNullSafe(F.col(f"_{key}"))
    return same


def rolling_peaks(capped, keys: Sequence[str] = ("user_id", "surface")) -> DataFrame:
    """Per user and surface: peak rolling spend, calls over the limit, first such call."""
    over = F.col("over_limit")
    return capped.groupBy(*keys).agg(
        F.max("rolling_credits").cast("double").alias("peak_credits"),
        F.count(F.when(over, 1)).alias("calls_over"),
        F.min(F.when(over, F.col("event_timestamp"))).alias("first_over"),
    )


def _pct(threshold: float) -> Column:
    return dec(threshold).cast("decimal(6,2)")


def budget_burn(
    calls,
    limits,
    scope: Column,
    as_of=None,
    time_col="usage_time",
    credit_col="token_credits",
    thresholds: Sequence[float] = BUDGET_THRESHOLDS,
    months: int | None = 1,
) -> DataFrame:
    """Spend per budget scope and month, and when it first reached each threshold.

    ``limits`` has scope and credits per month; calls of other scopes are left
    out. One row per scope, month and threshold with spend, with a NULL
    crossing while the threshold is not reached. With ``as_of`` the calls of the last
    ``months`` calendar months count, the month of ``as_of`` included: month to date
    by default, all history with None.

    A running total over all calls of a scope would put an account-wide budget
    into one task. Instead sums per minute find the minute in which a threshold
    can be crossed, and only the calls of those minutes are put in order.
    """
    if as_of is not None:
        calls = recent(calls, time_col, as_of, since=months and month_start(as_of, months))
    # A call without a time belongs to no month. Tying the scope to the time also
    # keeps a constant scope a join key, where it would fold into a cross join.
    spent = calls.select(
        F.when(F.col(time_col).isNotNull(), scope).alias("scope"),
        F.col(time_col).alias("at"),
        truncated(calls, "month", time_col).alias("month"),
        truncated(calls, "minute", time_col).alias("minute"),
        credit(credit_col).alias("c"),
    )
    budgets = limits.select("scope", credit("credits").alias("budget"))
    earlier = (
        Window.partitionBy("scope", "month")
        .orderBy("minute")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before, spend = F.coalesce(F.col("before"), dec(0)), F.col("spend")
    targets = {p: F.col("budget") * dec(p) * dec("0.01") for p in thresholds}
    # A minute can hold the crossing when no earlier minute ended at the target
    # and its charges alone, refunds left out, would reach it.
    hits = F.array(
        *[
            F.when(
                (before + F.col("most") >= target)
                & (F.coalesce(F.col("peak"), dec(0)) < target),
                F.struct(_pct(p).alias("pct"), "minute", before.alias("before")),
            )
            for p, target in targets.items()
        ]
    )
    months = (
        spent.groupBy("scope", "month", "minute")
        .agg(F.sum("c").alias("spend"), F.sum(F.greatest("c", dec(0))).alias("most"))
        .join(budgets, "scope")
        .withColumn("before", F.sum("spend").over(earlier))
        .withColumn("peak", F.max(before + spend).over(earlier))
        .withColumn("hits", F.array_compact(hits))
        .groupBy("scope", "month", "budget")
        .agg(
            resummed("spend").alias("spend"),
            F.flatten(F.collect_list(F.when(F.size("hits") > 0, F.col("hits")))).alias("hits"),
        )
        # One row per scope and month: a small exchange that all later uses share.
        .repartition("scope", "month", "budget", "spend")
    )
    steps = (
        months.select("*", F.explode(F.array(*[_pct(p) for p in thresholds])).alias("pct"))
        .withColumn("hits", F.filter("hits", lambda h: h["pct"] == F.col("pct")))
        .select("*", F.explode_outer("hits").alias("hit"))
        .select("scope", "month", "budget", "spend", "pct", "hit.minute", "hit.before")
        .withColumn("target", F.col("budget") * F.col("pct") * dec("0.01"))
    )
    minutes = (
        steps.where(F.col("minute").isNotNull()).select("scope", "month", "minute").distinct()
    )
    moments = (
        spent.join(minutes, ["scope", "month", "minute"], "left_semi")
        .groupBy("scope", "month", "minute", "at")
        .agg(F.sum("c").alias("c"))
    )
    up_to = (
        Window.partitionBy("scope", "month", "minute")
        .orderBy("at")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = moments.withColumn("running", F.sum("c").over(up_to)).drop("c")
    crossed = F.min(
        F.when(F.col("before") + F.col("running") >= F.col("target"), F.col("at"))
    )
    return (
        steps.join(running, ["scope", "month", "minute"], "left")
        .groupBy("scope", "month", "pct", "budget", "spend")
        .agg(crossed.alias("crossed_at"))
        .select(
            "scope",
            "month",
            F.col("budget").cast("double").alias("budget"),
            F.col("spend").cast("double").alias("spend"),
            quotient(F.col("spend"), F.col("budget"), 1, times=100).cast("double").alias("pct_used"),
            F.col("pct").cast("double").alias("threshold_pct"),
            "crossed_at",
        )
        .orderBy("scope", "month", "threshold_pct")
    )


def model_allowlist(
    calls, models: str | Sequence[str] = "ALL", as_of=None, days=None, time_col="start_time"
) -> DataFrame:
    """Calls the allowlist would block.

    ``"ALL"`` blocks nothing and ``"NONE"`` everything; otherwise only the
    listed models pass, given as a sequence or one comma-separated text. Calls
    of managed functions name no model and pass any list, an empty one included.
    """
    calls = _window(calls, time_col, as_of, days)
    if isinstance(models, str):
        mode = models.strip().upper()
        if mode in ("ALL", "NONE"):
            return calls.where(F.lit(mode == "NONE"))
        models = [m.strip() for m in models.split(",") if m.strip()]
    return calls.where(F.col("model_name").isNotNull() & ~F.col("model_name").isin(*models))


def run_budget(
    steps,
    run="conv_id",
    step="turn",
    tokens="tokens",
    seconds="seconds",
    max_tokens=RUN_TOKENS,
    max_seconds=RUN_SECONDS,
    block_steps=1_000,
    as_of=None,
    days=None,
    time_col="event_timestamp",
) -> DataFrame:
    """Agent runs over their token or time budget, with the first step over it.

    ``tokens`` and ``seconds`` are what each step used. A window takes the steps in
    it, so a run that began before it counts from there on.
    """
    steps = _window(steps, time_col, as_of, days)
    per_step = steps.groupBy(run, step).agg(
        F.sum(tokens).alias("tokens"), F.sum(seconds).alias("seconds")
    )
    used_tokens, used_seconds = F.col("running_tokens"), F.col("running_seconds")
    over_tokens, over_seconds = used_tokens > max_tokens, used_seconds > max_seconds
    reason = (
        F.when(over_tokens & over_seconds, "tokens and seconds")
        .when(over_tokens, "tokens")
        .otherwise("seconds")
    )
    return (
        running_totals(
            per_step, [run], step, ["tokens", "seconds"], F.floor(F.col(step) / block_steps)
        )
        .where(over_tokens | over_seconds)
        .groupBy(run)
        .agg(F.min(F.struct(step, used_tokens, used_seconds, reason.alias("reason"))).alias("f"))
        .select(
            run,
            F.col(f"f.{step}").alias("first_step_over"),
            F.col("f.running_tokens").alias("tokens_used"),
            F.col("f.running_seconds").alias("seconds_used"),
            F.col("f.reason").alias("reason"),
        )
    )


def role_grant_check(
    calls, approved: Sequence[str], as_of=None, days=None, time_col="start_time"
) -> DataFrame:
    """Calls made with no approved role, calls without any role included."""
    calls = _window(calls, time_col, as_of, days)
    granted = F.arrays_overlap("role_names", F.lit(list(approved)))
    return calls.where(~F.coalesce(granted, F.lit(False)))


def tag_format_check(
    usage, required: Sequence[str] = REQUIRED_TAG_KEYS, as_of=None, days=None, time_col="usage_time"
) -> DataFrame:
    """Calls whose tag lacks a required key, with the missing keys listed."""
    usage = _window(usage, time_col, as_of, days)
    tag = F.col("query_tag")
    missing = F.concat_ws(
        ",", *[F.when(tag_value(tag, key).isNull(), F.lit(key)) for key in required]
    )
    return usage.withColumn("missing_keys", missing).where("missing_keys <> ''")


def budget_history_latest(budgets, as_of, days=30, n=5) -> DataFrame:
    """The newest budget rows."""
    return (
        recent(budgets, "start_time", as_of, days=days)
        .orderBy(F.desc_nulls_first("start_time"), "budget_name")
        .limit(n)
        .select(
            "budget_name",
            credit("spending_limit").cast("double").alias("spending_limit"),
            credit("credit_quota").cast("double").alias("credit_quota"),
        )
    )
