"""Waste: oversized models, repeated calls, growing prompts, idle services."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlens.functions.money import (
    PRICE_PER_CREDIT,
    credit,
    dec,
    dollars,
    mean,
    per_million,
    quotient,
    ratio,
    resummed,
    rounded,
    total,
)
from spendlens.functions.time import literal_like, parse_as_of, recent
from spendlens.operators.attribution import explode_roles
from spendlens.operators.tracking import COMPLETION_FUNCTIONS
from spendlens.plans.rollup import FUNCTION_LOG, SQL_LOG, Usage

# Credits per GB and month while a search service serves.
SERVING_RATE = 6.3

# Task, model in use, cheaper model, saving in percent (10 to 50 times
# cheaper is 90 to 98 percent).
MODEL_SWITCHES = (
    ("summarization", "claude-4-sonnet", "mistral-7b", 30, 60),
    ("summarization", "llama3.1-405b", "mistral-7b", 30, 60),
    ("summarization", "mistral-large", "mistral-7b", 30, 60),
    ("right-sizing", "claude-4-sonnet", "mistral-7b", 90, 98),
)

# Task, function in use, cheaper function, saving in percent.
ALTERNATIVES = (
    ("sentiment", "AI_COMPLETE", "AI_SENTIMENT", 40, 70),
    ("classification", "AI_COMPLETE", "AI_CLASSIFY", 50, 75),
    ("extraction", "AI_COMPLETE", "AI_EXTRACT", 30, 60),
    ("filtering", "AI_COMPLETE", "AI_FILTER", 50, 70),
    ("translation", "AI_COMPLETE", "AI_TRANSLATE", 40, 60),
)


def rate_per_million(usage, as_of, days=30) -> DataFrame:
    """Tokens, credits and credits per 1M tokens per model and function."""
    log = Usage.of(usage, SQL_LOG).window(as_of, days=days)
    return (
        log.df.groupBy("model_name", "function_name")
        .agg(log.tokens().alias("total_tokens"), log.credits().alias("c"))
        .select(
            "model_name",
            "function_name",
            "total_tokens",
            F.col("c").cast("double").alias("total_credits"),
            rounded(per_million(F.col("c"), F.col("total_tokens")), 2).alias(
                "credits_per_1m_tokens"
            ),
        )
        .orderBy(
            F.desc_nulls_first("credits_per_1m_tokens"), "model_name", "function_name"
        )
    )


def model_tiers(usage, as_of, days=30, cut=(2.0, 5.0), price=PRICE_PER_CREDIT) -> DataFrame:
    """Rate per model with its tier; a model without tokens counts as Premium."""
    log = Usage.of(usage, SQL_LOG).window(as_of, days=days)
    rate = per_million(F.col("c"), F.col("total_tokens"))
    tier = (
        F.when(rate < dec(cut[0]), "Budget")
        .when(rate < dec(cut[1]), "Standard")
        .otherwise("Premium")
    )
    return (
        log.df.groupBy("model_name")
        .agg(
            log.calls().alias("total_calls"),
            log.tokens().alias("total_tokens"),
            log.credits().alias("c"),
        )
        .select(
            "model_name",
            "total_calls",
            "total_tokens",
            F.col("c").cast("double").alias("total_credits"),
            rounded(rate, 2).alias("credits_per_1m_tokens"),
            dollars(F.col("c"), price).alias("est_dollars"),
            tier.alias("cost_tier"),
        )
        .orderBy(F.desc_nulls_first("credits_per_1m_tokens"), "model_name")
    )


def completion_audit(
    calls,
    as_of,
    days=30,
    functions: Sequence[str] | None = COMPLETION_FUNCTIONS,
    price=PRICE_PER_CREDIT,
) -> DataFrame:
    """Cost per function and model of the given functions; ``None`` means all."""
    log = Usage.of(calls, FUNCTION_LOG).window(as_of, days=days)
    if functions is not None:
        log = log.where(F.col("function_name").isin(*functions))
    return (
        log.df.groupBy("function_name", "model_name")
        .agg(log.calls().alias("call_count"), log.credits().alias("c"))
        .select(
            "function_name",
            "model_name",
            "call_count",
            F.col("c").cast("double").alias("total_credits"),
            rounded(ratio(F.col("c"), F.col("call_count")), 6).alias("avg_credits_per_call"),
            dollars(F.col("c"), price).alias("est_dollars"),
        )
        .orderBy(F.desc_nulls_first("total_credits"), "function_name", "model_name")
    )


def duplicate_calls_by_user(calls, users, as_of, days=7, more_than=20) -> DataFrame:
    """Known users with more than ``more_than`` calls of a function on one day."""
    log = Usage.of(calls, FUNCTION_LOG).window(as_of, days=days)
    return (
        log.df.groupBy("user_id", "function_name", log.bucket("day").alias("day"))
        .agg(log.calls().alias("daily_calls"), log.credits().alias("c"))
        .where(F.col("daily_calls") > more_than)
        .join(users.select("user_id", "name"), "user_id")
        .select(
            "user_id",
            "name",
            "function_name",
            "day",
            "daily_calls",
            F.col("c").cast("double").alias("daily_credits"),
        )
        .orderBy(F.desc_nulls_first("daily_credits"), "user_id", "function_name", "day")
    )


def duplicate_calls_by_tag(usage, as_of, days=7, more_than=10) -> DataFrame:
    """Tags that repeat a function more than ``more_than`` times."""
    return (
        recent(usage, "usage_time", as_of, days=days)
        .groupBy("query_tag", "function_name")
        .agg(
            F.count(F.lit(1)).alias("repetitions"),
            total("token_credits").cast("double").alias("total_credits"),
            F.min("usage_time").alias("first_call"),
            F.max("usage_time").alias("last_call"),
        )
        .where(F.col("repetitions") > more_than)
        .orderBy(F.desc_nulls_first("total_credits"), "query_tag", "function_name")
    )


def prompt_trend(usage, as_of, days=60) -> DataFrame:
    """Mean tokens per call by function and week (Monday start)."""
    log = Usage.of(usage, SQL_LOG).window(as_of, days=days)
    return (
        log.df.groupBy("function_name", log.bucket("week").alias("week"))
        .agg(
            log.tokens().alias("t"),
            log.credits().alias("c"),
            log.calls().alias("call_count"),
        )
        .select(
            "function_name",
            "week",
            mean(F.col("t"), F.col("call_count")).alias("avg_tokens_per_call"),
            F.col("c").cast("double").alias("weekly_credits"),
            "call_count",
        )
        .orderBy(F.asc_nulls_last("function_name"), "week")
    )


def high_token_calls(usage, as_of, days=7, over: int | None = 50_000, n=20) -> DataFrame:
    """The ``n`` calls with the most tokens above ``over``; ``None`` sets no threshold."""
    log = recent(usage, "usage_time", as_of, days=days)
    if over is not None:
        log = log.where(F.col("tokens") > over)
    return (
        log.select(
            "query_id",
            "model_name",
            "function_name",
            "tokens",
            credit("token_credits").cast("double").alias("token_credits"),
            "usage_time",
        )
        .orderBy(F.desc_nulls_first("tokens"), "query_id")
        .limit(n)
    )


def granular_breakdown(usage, as_of, days=7, n=20) -> DataFrame:
    """The ``n`` costliest calls with their input, output and reasoning parts."""
    parts = ("input", "output", "reasoning")
    return (
        recent(usage, "usage_time", as_of, days=days)
        .select(
            "query_id",
            "model_name",
            "tokens",
            credit("token_credits").cast("double").alias("token_credits"),
            *[F.col(f"tokens_granular.{p}").alias(f"{p}_tokens") for p in parts],
            *[
                F.col(f"token_credits_granular.{p}").cast("double").alias(f"{p}_credits")
                for p in parts
            ],
        )
        .orderBy(F.desc_nulls_first("token_credits"), "query_id")
        .limit(n)
    )


def _credits_when(condition: Column) -> Column:
    return F.sum(F.when(condition, credit("credits")).otherwise(dec(0).cast("decimal(18,9)")))


def idle_services(search, as_of, days=30, standing_types=("INDEXING",)) -> DataFrame:
    """Standing against query credits per search service, least queried first.

    Serving credits accrue without queries too; add ``"SERVING"`` to
    ``standing_types`` to count them.
    """
    kind = F.col("consumption_type")
    return (
        recent(search, "usage_date", as_of, days=days)
        .groupBy("service_name")
        .agg(
            _credits_when(kind.isin(*standing_types)).alias("idx"),
            _credits_when(kind == "QUERY").alias("qry"),
        )
        .where("idx > 0")
        .select(
            "service_name",
            F.col("idx").cast("double").alias("idx_credits"),
            F.col("qry").cast("double").alias("qry_credits"),
            quotient(F.col("qry"), F.col("idx"), 1, times=100).cast("double").alias("query_pct"),
        )
        .orderBy(F.asc_nulls_last("query_pct"), "service_name")
    )


def service_detail(search, as_of, days=30) -> DataFrame:
    """Credits, tokens and first and last day per service and consumption type."""
    keys = ("service_name", "database_name", "schema_name", "consumption_type")
    return (
        recent(search, "usage_date", as_of, days=days)
        .groupBy(*keys)
        .agg(
            total("credits").cast("double").alias("total_credits"),
            F.sum("tokens").alias("total_tokens"),
            F.min("usage_date").alias("first_usage"),
            F.max("usage_date").alias("last_usage"),
        )
        .orderBy(F.desc_nulls_first("total_credits"), *keys)
    )


def cleanup_candidates(search, as_of, days=30, idle_days=14) -> DataFrame:
    """Services never queried in the window, or not for ``idle_days`` days."""
    kind = F.col("consumption_type")
    today = literal_like(parse_as_of(as_of), search.schema["usage_date"].dataType)
    return (
        recent(search, "usage_date", as_of, days=days)
        .groupBy("service_name")
        .agg(
            F.max(F.when(kind == "QUERY", F.col("usage_date"))).alias("last_query_date"),
            _credits_when(kind == "INDEXING").cast("double").alias("indexing_credits_wasted"),
        )
        .withColumn("days_since_last_query", F.datediff(today, "last_query_date"))
        .where(F.col("last_query_date").isNull() | (F.col("days_since_last_query") > idle_days))
        .select(
            "service_name",
            "last_query_date",
            "days_since_last_query",
            "indexing_credits_wasted",
        )
        .orderBy(F.desc_nulls_first("indexing_credits_wasted"), "service_name")
    )


def indexing_by_service(search, as_of, days=30) -> DataFrame:
    """Indexing credits per service."""
    return (
        recent(search, "usage_date", as_of, days=days)
        .where(F.col("consumption_type") == "INDEXING")
        .groupBy("service_name")
        .agg(total("credits").cast("double").alias("monthly_credits"))
        .orderBy(F.desc_nulls_first("monthly_credits"), "service_name")
    )


def call_cost_gap(usage, as_of, days=14) -> DataFrame:
    """Highest and mean cost of a call per day; a wide gap points to a loop."""
    log = Usage.of(usage, SQL_LOG).window(as_of, days=days)
    return (
        log.df.groupBy(log.bucket("day").alias("day"))
        .agg(
            log.most().alias("hi"),
            log.credits().alias("c"),
            log.calls().alias("total_calls"),
        )
        .select(
            "day",
            F.col("hi").cast("double").alias("max_call"),
            mean(F.col("c"), F.col("total_calls")).alias("avg_call"),
            "total_calls",
        )
        .orderBy(F.desc_nulls_first("day"))
    )


def heavy_call_users(usage, users, as_of, days=7, avg_over=0.01) -> DataFrame:
    """Known users whose mean call costs more than ``avg_over`` credits."""
    log = Usage.of(usage, SQL_LOG).window(as_of, days=days)
    return (
        log.df.groupBy("user_id")
        .agg(log.calls().alias("n"), log.credits().alias("c"), log.most().alias("hi"))
        .join(users.select("user_id", F.col("name").alias("user_name")), "user_id")
        .groupBy("user_name")
        .agg(
            F.sum("n").alias("total_calls"),
            resummed("c").alias("c"),
            F.max("hi").cast("double").alias("max_single_call"),
        )
        .where(F.col("c") > F.col("total_calls") * dec(avg_over))
        .select(
            "user_name",
            "total_calls",
            F.col("c").cast("double").alias("total_credits"),
            mean(F.col("c"), F.col("total_calls")).alias("avg_credits_per_call"),
            "max_single_call",
        )
        .orderBy(F.desc_nulls_first("avg_credits_per_call"), "user_name")
    )


def usage_by_hour_of_day(usage, users, as_of, days=30, n=30) -> DataFrame:
    """Known users and hours of the day with the most spend."""
    log = Usage.of(usage, SQL_LOG).window(as_of, days=days)
    return (
        log.df.groupBy("user_id", F.hour(log.time_col).cast("bigint").alias("hour_of_day"))
        .agg(log.calls().alias("calls"), log.credits().alias("c"))
        .join(users.select("user_id", F.col("name").alias("user_name")), "user_id")
        .groupBy("user_name", "hour_of_day")
        .agg(F.sum("calls").alias("calls"), F.sum("c").cast("double").alias("credits"))
        .orderBy(F.desc_nulls_first("credits"), "user_name", "hour_of_day")
        .limit(n)
    )


def role_like_spend(calls, as_of, pattern="%DEV%", days=7) -> DataFrame:
    """Credits of roles whose name matches; after a clean-up there are none."""
    return (
        explode_roles(recent(calls, "start_time", as_of, days=days))
        .where(F.col("role_name").ilike(pattern))
        .groupBy("role_name")
        .agg(F.sum("credits").cast("double").alias("credits"))
        .orderBy("role_name")
    )


def service_sizes(search, as_of, days=30, bytes_per_token=4) -> DataFrame:
    """Size of each search service and the share of the window's days on which it served.

    The size is that of the tokens the service handled in the window.
    """
    served = F.countDistinct(F.when(F.col("consumption_type") == "SERVING", F.col("usage_date")))
    kb = F.col("kb").cast("decimal(20,0)")
    return (
        recent(search, "usage_date", as_of, days=days, whole_days=True)
        .groupBy("service_name")
        .agg((F.sum("tokens") * bytes_per_token).alias("kb"), served.alias("served"))
        .select(
            "service_name",
            (kb * dec("0.000001")).cast("decimal(20,6)").alias("gb"),
            F.round(F.col("served").cast("decimal(9,0)") / days, 4).cast("decimal(5,4)").alias("resumed_share"),
        )
    )


def standing_cost(sizes, rate=SERVING_RATE, price=PRICE_PER_CREDIT) -> DataFrame:
    """Monthly serving cost per service from its size and resumed share.

    ``sizes`` has service_name, gb and resumed_share (0 to 1) as DECIMAL.
    """
    cost = F.col("gb") * F.col("resumed_share") * dec(rate)
    return sizes.select(
        "service_name",
        F.col("gb").cast("double").alias("gb"),
        F.col("resumed_share").cast("double").alias("resumed_share"),
        rounded(cost, 4).alias("monthly_credits"),
        dollars(cost, price).alias("est_dollars"),
    ).orderBy(F.desc_nulls_first("monthly_credits"), "service_name")


def _options(alternatives) -> dict[str, Column]:
    """Per function or model in use, the cheaper choices as an array of structs."""
    options: dict[str, list[Column]] = {}
    for task, current, cheaper, low, high in alternatives:
        options.setdefault(current, []).append(
            F.struct(
                F.lit(task).alias("task"),
                F.lit(cheaper).alias("cheaper"),
                dec(low).cast("decimal(5,2)").alias("low"),
                dec(high).cast("decimal(5,2)").alias("high"),
            )
        )
    return {current: F.array(*structs) for current, structs in options.items()}


def _savings(log: Usage, by: str, alternatives) -> DataFrame:
    """Spend per function and model with each cheaper choice and its saving."""
    options = _options(alternatives)
    choice = F.lit(None)
    for current, structs in options.items():
        choice = F.when(F.col(by) == current, structs).otherwise(choice)
    return (
        log.df.where(F.col(by).isin(*options))
        .groupBy("function_name", "model_name")
        .agg(log.credits().alias("c"))
        .select("function_name", "model_name", "c", F.explode(choice).alias("o"))
        .select(
            F.col("o.task").alias("task"),
            "function_name",
            "model_name",
            F.col("o.cheaper").alias("cheaper"),
            "c",
            (F.col("c") * F.col("o.low") * dec("0.01")).alias("low"),
            (F.col("c") * F.col("o.high") * dec("0.01")).alias("high"),
        )
    )


def _saving_columns(price: float) -> list[Column]:
    low, high = F.col("low"), F.col("high")
    return [
        F.col("c").cast("double").alias("credits"),
        rounded(low, 4).alias("low_saving"),
        rounded(high, 4).alias("high_saving"),
        dollars(low, price).alias("low_dollars"),
        dollars(high, price).alias("high_dollars"),
    ]


def rightsizing_savings(
    calls, as_of, days=30, alternatives=ALTERNATIVES, price=PRICE_PER_CREDIT
) -> DataFrame:
    """What moving each function's spend to a cheaper one would save.

    The log does not say what task a completion call solved, so every line
    assumes that all of the function's spend belongs to its task: read it as
    the saving per task share, not as a sum over tasks.
    """
    log = Usage.of(calls, FUNCTION_LOG).window(as_of, days=days)
    return (
        _savings(log, "function_name", alternatives)
        .select(
            "task",
            F.col("function_name").alias("generic"),
            "model_name",
            F.col("cheaper").alias("specific"),
            *_saving_columns(price),
        )
        .orderBy(F.desc_nulls_first("high_saving"), "task", "model_name")
    )


def model_switch_savings(
    calls,
    as_of,
    days=30,
    switches=MODEL_SWITCHES,
    functions=COMPLETION_FUNCTIONS,
    price=PRICE_PER_CREDIT,
) -> DataFrame:
    """What moving a model's completion spend to a cheaper model would save.

    As above, a line assumes that all of the model's spend belongs to its task.
    """
    log = Usage.of(calls, FUNCTION_LOG).window(as_of, days=days)
    log = log.where(F.col("function_name").isin(*functions))
    return (
        _savings(log, "model_name", switches)
        .select(
            "task", "function_name", "model_name",
            F.col("cheaper").alias("cheaper_model"), *_saving_columns(price),
        )
        .orderBy(F.desc_nulls_first("high_saving"), "task", "model_name", "function_name")
    )
