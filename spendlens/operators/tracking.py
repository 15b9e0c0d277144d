"""Spend tracking: by function, model, hour, statement and assistant user."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlens.functions.money import (
    PRICE_PER_CREDIT,
    credit,
    dec,
    dollars,
    quotient,
    ratio,
    resummed,
    rounded,
    total,
)
from spendlens.functions.text import like_any
from spendlens.functions.time import recent, truncated
from spendlens.plans.rollup import FUNCTION_LOG, Usage

# Functions that take a free prompt and a model.
COMPLETION_FUNCTIONS = ("COMPLETE", "AI_COMPLETE")

# Statement texts that count as AI use.
AI_PATTERNS = (
    "%AI_COMPLETE%",
    "%AI_SENTIMENT%",
    "%AI_CLASSIFY%",
    "%AI_TRANSLATE%",
    "%AI_SUMMARIZE%",
    "%AI_EMBED%",
    "%AI_FILTER%",
    "%AI_EXTRACT%",
    "%SNOWFLAKE.CORTEX%",
)

# Metering types of the two assistant surfaces.
ASSISTANT_SERVICES = ("CORTEX_CODE_CLI", "CORTEX_CODE_SNOWSIGHT")

# Row counts of the projection table.
TARGET_ROWS = (500, 5_000, 50_000, 500_000, 1_000_000)


def users_like(users: DataFrame, text: str) -> DataFrame:
    """Users whose name contains ``text``, ignoring case; ``%`` and ``_`` are wildcards."""
    return users.where(F.col("name").ilike(f"%{text}%"))


def _only_users(grouped: DataFrame, users: DataFrame | None, text: str | None) -> DataFrame:
    """Keep the groups of users whose name matches; without a text keep all."""
    if not text:
        return grouped
    if users is None:
        raise ValueError("a user filter needs the users table")
    return grouped.join(users_like(users, text), "user_id", "left_semi")


def _by(
    usage: Usage, keys: dict[str, Column], users: DataFrame | None, user_like: str | None
) -> DataFrame:
    """Calls and credits per key, over all users or those whose name matches.

    With a user filter the log is first grouped by user as well, so the join
    with users meets one row per user and key, not one per call.
    """
    names = list(keys)
    columns = [c.alias(n) for n, c in keys.items()]
    if not user_like:
        return usage.df.groupBy(*columns).agg(
            usage.calls().alias("calls"), usage.credits().alias("credits")
        )
    per_user = usage.df.groupBy(*columns, "user_id").agg(
        usage.calls().alias("calls"), usage.credits().alias("credits")
    )
    return (
        _only_users(per_user, users, user_like)
        .groupBy(*names)
        .agg(F.sum("calls").alias("calls"), resummed("credits").alias("credits"))
    )


def spend_by_function(calls, as_of, days=7, price=PRICE_PER_CREDIT) -> DataFrame:
    """Calls, credits (total, mean, least, most) and dollars per function."""
    log = Usage.of(calls, FUNCTION_LOG).window(as_of, days=days)
    return (
        log.df.groupBy("function_name")
        .agg(
            log.calls().alias("n"),
            log.credits().alias("c"),
            log.least().alias("lo"),
            log.most().alias("hi"),
        )
        .select(
            "function_name",
            F.col("n").alias("call_count"),
            rounded(F.col("c"), 4).alias("total_ai_credits"),
            rounded(ratio(F.col("c"), F.col("n")), 6).alias("avg_credits_per_call"),
            rounded(F.col("lo"), 6).alias("min_credits"),
            rounded(F.col("hi"), 6).alias("max_credits"),
            dollars(F.col("c"), price).alias("est_dollars"),
        )
        .orderBy(F.desc_nulls_first("total_ai_credits"), "function_name")
    )


def model_cost_comparison(
    calls, as_of, hours=2, functions=COMPLETION_FUNCTIONS, price=PRICE_PER_CREDIT
) -> DataFrame:
    """Cost per call of each model, completion functions only."""
    log = Usage.of(calls, FUNCTION_LOG).window(as_of, hours=hours)
    return (
        log.df.where(F.col("function_name").isin(*functions))
        .groupBy("model_name", "function_name")
        .agg(log.calls().alias("calls"), log.credits().alias("c"))
        .select(
            "model_name",
            "function_name",
            "calls",
            rounded(F.col("c"), 4).alias("total_ai_credits"),
            rounded(ratio(F.col("c"), F.col("calls")), 6).alias("credits_per_call"),
            dollars(F.col("c"), price).alias("est_dollars"),
        )
        .orderBy(F.desc_nulls_first("total_ai_credits"), "model_name", "function_name")
    )


def hourly_spend(calls, as_of, days=1, price=PRICE_PER_CREDIT) -> DataFrame:
    """Calls, credits and dollars per hour and function."""
    log = Usage.of(calls, FUNCTION_LOG).window(as_of, days=days)
    return (
        log.df.groupBy(log.bucket("hour").alias("hour_bucket"), "function_name")
        .agg(log.calls().alias("ai_calls"), log.credits().alias("c"))
        .select(
            "hour_bucket",
            "function_name",
            "ai_calls",
            rounded(F.col("c"), 4).alias("ai_credits"),
            dollars(F.col("c"), price).alias("est_dollars"),
        )
        .orderBy(
            F.desc_nulls_first("hour_bucket"),
            F.desc_nulls_first("ai_credits"),
            "function_name",
        )
    )


def hourly_trend(calls, as_of, days=7, users=None, user_like=None) -> DataFrame:
    """Calls and credits per hour, for all users or those whose name matches."""
    log = Usage.of(calls, FUNCTION_LOG).window(as_of, days=days)
    return (
        _by(log, {"hour_bucket": log.bucket("hour")}, users, user_like)
        .select(
            "hour_bucket",
            F.col("calls").alias("queries"),
            F.coalesce(rounded(F.col("credits"), 4), F.lit(0.0)).alias("credits"),
        )
        .orderBy(F.asc_nulls_last("hour_bucket"))
    )


def recent_ai_queries(history, user, as_of, hours=1, patterns=AI_PATTERNS) -> DataFrame:
    """One user's recent statements that use AI functions, newest first."""
    return (
        recent(history, "start_time", as_of, hours=hours)
        .where((F.col("user_name") == user) & like_any(F.col("query_text"), patterns))
        .select(
            "query_id",
            F.left("query_text", F.lit(120)).alias("query_preview"),
            "start_time",
            rounded(ratio(F.col("total_elapsed_time"), dec(1000)), 2).alias("seconds"),
            rounded(credit("credits_used_cloud_services"), 6).alias("credits_used"),
        )
        .orderBy(F.desc_nulls_first("start_time"), "query_id")
    )


def latest_ai_queries(history, as_of, limit=50, patterns=AI_PATTERNS, days=None) -> DataFrame:
    """Of the latest ``limit`` statements, those that use AI functions.

    ``days`` bounds how far back a stored log is read; None reads all of it.
    """
    newest = (F.desc_nulls_first("start_time"), F.asc("query_id"))
    return (
        recent(history, "start_time", as_of, days=days)
        .select("query_id", "query_text", "start_time", "total_elapsed_time")
        .orderBy(*newest)
        .limit(limit)
        .where(like_any(F.col("query_text"), patterns))
        .select(
            "query_id",
            F.left("query_text", F.lit(100)).alias("query_preview"),
            "start_time",
            (F.col("total_elapsed_time") / F.lit(1000.0)).alias("seconds"),
        )
        .orderBy(*newest)
    )


def quota_status(monitors, name=None) -> DataFrame:
    """Credits used against the quota of each monitor, or of the named one."""
    rows = monitors if name is None else monitors.where(F.col("name") == name)
    used, quota = credit("credits_used"), credit("credit_quota")
    return rows.select(
        F.col("name").alias("monitor_name"),
        quota.cast("double").alias("credit_quota"),
        rounded(used, 2).alias("credits_used"),
        quotient(used, quota, 2, times=100).cast("double").alias("pct_used"),
        rounded(credit("credits_used_compute"), 2).alias("credits_used_compute"),
        rounded(credit("credits_used_cloud_services"), 4).alias("credits_used_cloud_services"),
    )


def recent_call_costs(calls, as_of, hours=1, n=10) -> DataFrame:
    """The latest ``n`` calls with their cost."""
    return (
        recent(calls, "start_time", as_of, hours=hours)
        .select(
            "query_id",
            "function_name",
            "model_name",
            rounded(credit("credits"), 6).alias("ai_credits"),
            "start_time",
        )
        .orderBy(F.desc_nulls_first("start_time"), "query_id")
        .limit(n)
    )


def _sample(calls: DataFrame, query_ids: DataFrame | Sequence[str] | None) -> DataFrame:
    if query_ids is None:
        return calls
    if isinstance(query_ids, DataFrame):
        return calls.join(query_ids.select("query_id"), "query_id", "left_semi")
    return calls.where(F.col("query_id").isin(*query_ids))


def _window(calls: DataFrame, as_of, days) -> DataFrame:
    return calls if as_of is None else recent(calls, "start_time", as_of, days=days)


def project_cost(
    calls, query_ids, price=PRICE_PER_CREDIT, as_of=None, days=None
) -> DataFrame:
    """Cost of a sample scaled by 100, 10,000 and 100,000.

    The factors are fixed: they mean 500, 50k and 500k rows for a five-row
    sample. ``project_to_rows`` scales a sample of any size.
    """
    c, n = F.col("c"), F.col("n")
    return (
        _sample(_window(calls, as_of, days), query_ids)
        .agg(total("credits").alias("c"), F.count(F.lit(1)).alias("n"))
        .select(
            c.cast("double").alias("sample_credits"),
            n.alias("sample_calls"),
            rounded(ratio(c, n), 6).alias("credits_per_call"),
            rounded(c * dec(100), 4).alias("projected_500_rows"),
            rounded(c * dec(10_000), 2).alias("projected_50k_rows"),
            rounded(c * dec(100_000), 2).alias("projected_500k_rows"),
            dollars(c * dec(100_000), price).alias("projected_500k_dollars"),
        )
    )


def project_to_rows(
    calls,
    query_ids=None,
    sample_rows=None,
    targets=TARGET_ROWS,
    price=PRICE_PER_CREDIT,
    as_of=None,
    days=None,
) -> DataFrame:
    """Cost of a sample per processed row, and for each target number of rows.

    ``sample_rows`` is the number of rows the sample processed; by default one
    row per call. An empty or free sample gives NULLs.
    """
    rows = F.count(F.lit(1)) if sample_rows is None else F.lit(sample_rows).cast("bigint")
    usable = (F.col("c") > 0) & (F.col("rows") > 0)
    scaled = F.when(usable, F.col("c") * F.col("target_rows"))
    return (
        _sample(_window(calls, as_of, days), query_ids)
        .agg(total("credits").alias("c"), rows.alias("rows"))
        .select("c", "rows", F.explode(F.lit(list(targets))).alias("target_rows"))
        .select(
            F.col("target_rows").cast("bigint").alias("target_rows"),
            rounded(F.when(usable, ratio(F.col("c"), F.col("rows"))), 6).alias(
                "credits_per_row"
            ),
            rounded(ratio(scaled, F.col("rows")), 4).alias("projected_credits"),
            rounded(ratio(scaled * dec(price), F.col("rows")), 2).alias("projected_dollars"),
        )
        .orderBy("target_rows")
    )


def assistant_daily(usage, as_of, days=7, price=PRICE_PER_CREDIT) -> DataFrame:
    """Sessions, tokens and credits per user and day of one assistant surface."""
    log = recent(usage, "event_timestamp", as_of, days=days)
    return (
        log.groupBy("user_name", truncated(log, "day", "event_timestamp").alias("usage_date"))
        .agg(
            F.count(F.lit(1)).alias("sessions"),
            F.sum("total_tokens").alias("total_tokens"),
            total("total_credits").alias("c"),
        )
        .select(
            "user_name",
            "usage_date",
            "sessions",
            "total_tokens",
            rounded(F.col("c"), 4).alias("total_credits"),
            dollars(F.col("c"), price).alias("est_dollars"),
        )
        .orderBy(
            F.desc_nulls_first("usage_date"),
            F.desc_nulls_first("total_credits"),
            "user_name",
        )
    )


def assistant_metering(metering, as_of, days=30, types=ASSISTANT_SERVICES) -> DataFrame:
    """Billed and used credits per assistant service type and day."""
    return (
        recent(metering, "usage_date", as_of, days=days, whole_days=True)
        .where(F.col("service_type").isin(*types))
        .groupBy("service_type", "usage_date")
        .agg(
            total("credits_billed").cast("double").alias("credits_billed"),
            total("credits_used").cast("double").alias("credits_used"),
        )
        .orderBy(F.desc_nulls_first("usage_date"), F.asc_nulls_last("service_type"))
    )


def assistant_top_users(cli, web, as_of, days=30, price=PRICE_PER_CREDIT) -> DataFrame:
    """Totals per user over both assistant surfaces."""
    columns = ("user_name", "total_tokens", "total_credits")
    both = [
        recent(usage, "event_timestamp", as_of, days=days).select(*columns)
        for usage in (cli, web)
    ]
    return (
        both[0]
        .unionByName(both[1])
        .groupBy("user_name")
        .agg(
            F.sum("total_tokens").alias("total_tokens"),
            total("total_credits").alias("c"),
            F.count(F.lit(1)).alias("total_sessions"),
        )
        .select(
            "user_name",
            "total_tokens",
            rounded(F.col("c"), 4).alias("total_credits"),
            dollars(F.col("c"), price).alias("est_dollars"),
            "total_sessions",
        )
        .orderBy(F.desc_nulls_first("total_credits"), "user_name")
    )


def assistant_by_user_model(
    usage, as_of, days=30, split=False, price=PRICE_PER_CREDIT
) -> DataFrame:
    """Credits per user and model of the token map.

    A request that used several models counts in full under each of them, so
    the sum exceeds true spend; ``split`` divides it among its models.
    """
    spent = credit("total_credits")
    if split:
        spent = ratio(spent, F.size("tokens_granular")).cast("decimal(38,18)")
    return (
        recent(usage, "event_timestamp", as_of, days=days)
        .select(
            "user_name",
            spent.alias("c"),
            F.explode(F.map_keys("tokens_granular")).alias("model_name"),
        )
        .groupBy("user_name", "model_name")
        .agg(F.sum("c").alias("c"))
        .select(
            "user_name",
            "model_name",
            F.col("c").cast("double").alias("total_credits"),
            dollars(F.col("c"), price, 4).alias("est_cost_usd"),
        )
        .orderBy(F.desc_nulls_first("total_credits"), "user_name", "model_name")
    )


def assistant_detail(usage, as_of=None, days=None, n=None) -> DataFrame:
    """One row per request and model of a window; the newest ``n`` of them in order.

    Without ``n`` the rows are not sorted: a whole log has no use for a global order.
    """
    if as_of is not None:
        usage = recent(usage, "event_timestamp", as_of, days=days)
    detail = (
        usage.select(
            "user_name",
            "event_timestamp",
            F.explode("tokens_granular").alias("model", "split"),
            F.col("total_tokens").alias("tokens"),
            credit("total_credits").cast("double").alias("credits"),
        )
        .select(
            "user_name",
            "event_timestamp",
            "model",
            F.col("split.input").alias("input_tokens"),
            F.col("split.output").alias("output_tokens"),
            "tokens",
            "credits",
        )
    )
    if n is None:
        return detail
    return detail.orderBy(F.desc_nulls_first("event_timestamp"), "user_name", "model").limit(n)


def daily_function_trend(calls, as_of, days=30) -> DataFrame:
    """Calls and credits per day and function."""
    log = Usage.of(calls, FUNCTION_LOG).window(as_of, days=days)
    return (
        log.df.groupBy(log.bucket("day").alias("day"), "function_name")
        .agg(log.calls().alias("calls"), log.credits().cast("double").alias("daily_credits"))
        .orderBy(
            F.desc_nulls_first("day"), F.desc_nulls_first("daily_credits"), "function_name"
        )
    )


def kpis(
    calls, users, as_of, days=7, user_like=None, function=None, price=PRICE_PER_CREDIT
) -> DataFrame:
    """One row: calls, credits, mean credits, distinct named users, dollars."""
    log = Usage.of(calls, FUNCTION_LOG).window(as_of, days=days)
    if function is not None:
        log = log.where(F.col("function_name") == function)
    named = users_like(users, user_like) if user_like else users
    c, n = F.col("c"), F.col("n")
    zero = F.lit(0.0)
    return (
        log.df.groupBy("user_id")
        .agg(log.calls().alias("calls"), log.credits().alias("credits"))
        .join(named.select("user_id", "name"), "user_id", "inner" if user_like else "left")
        .agg(
            F.coalesce(F.sum("calls"), F.lit(0)).alias("n"),
            resummed("credits").alias("c"),
            F.countDistinct("name").alias("unique_users"),
        )
        .select(
            n.alias("total_queries"),
            F.coalesce(rounded(c, 4), zero).alias("total_credits"),
            F.coalesce(rounded(ratio(c, n), 6), zero).alias("avg_credits"),
            "unique_users",
            F.coalesce(dollars(c, price), zero).alias("est_dollar_cost"),
        )
    )


def top_functions(calls, as_of, days=7, n=10, users=None, user_like=None) -> DataFrame:
    """The ``n`` functions with the highest positive spend."""
    log = Usage.of(calls, FUNCTION_LOG).window(as_of, days=days)
    return (
        _by(log, {"func_name": F.col("function_name")}, users, user_like)
        .where("credits > 0")
        .select("func_name", "calls", rounded(F.col("credits"), 4).alias("credits"))
        .orderBy(F.desc_nulls_first("credits"), "func_name")
        .limit(n)
    )


def model_panel(
    calls, as_of, days=7, functions=COMPLETION_FUNCTIONS, users=None, user_like=None
) -> DataFrame:
    """Completion calls and positive spend per model."""
    log = Usage.of(calls, FUNCTION_LOG).window(as_of, days=days)
    log = log.where(F.col("function_name").isin(*functions))
    return (
        _by(log, {"model_name": F.col("model_name")}, users, user_like)
        .where("credits > 0")
        .select(
            "model_name",
            "calls",
            rounded(F.col("credits"), 4).alias("total_credits"),
            rounded(ratio(F.col("credits"), F.col("calls")), 6).alias("credits_per_call"),
        )
        .orderBy(F.desc_nulls_first("total_credits"), "model_name")
    )
