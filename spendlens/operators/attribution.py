"""Attribution: spend by user, role, tag, team and service type.

Reports that name users first reduce the log to one row per user id and only
then join the users table, so neither a very active user nor a large users
table meets the raw log in a join. No side is broadcast by hint: Spark picks
the join from the sizes it sees.
"""

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
from spendlens.functions.tags import is_tagged, tag_value
from spendlens.functions.time import recent
from spendlens.operators.tracking import users_like
from spendlens.plans.rollup import FUNCTION_LOG, SQL_LOG, Usage

# Metering types that bill AI use.
AI_SERVICE_TYPES = (
    "AI_SERVICES",
    "CORTEX_AGENTS",
    "CORTEX_CODE_CLI",
    "CORTEX_CODE_SNOWSIGHT",
    "SNOWFLAKE_INTELLIGENCE",
)


def of_types(types: str | Sequence[str]) -> Column:
    """Metering rows of the listed types, or of types that match one ILIKE pattern.

    A pattern such as ``"%AI%"`` misses types that do not carry the letters in
    their name; the listed default does not.
    """
    kind = F.col("service_type")
    return kind.ilike(types) if isinstance(types, str) else kind.isin(*types)


def spend_by_user(calls, users, as_of, days=7, price=PRICE_PER_CREDIT) -> DataFrame:
    """Spend per user name; calls of unknown users are kept under NULL."""
    log = Usage.of(calls, FUNCTION_LOG).window(as_of, days=days)
    per_id = log.df.groupBy("user_id").agg(
        log.calls().alias("n"),
        log.credits().alias("c"),
        log.first().alias("first_call"),
        log.last().alias("last_call"),
    )
    return (
        per_id.join(users.select("user_id", "name"), "user_id", "left")
        .groupBy(F.col("name").alias("user_name"))
        .agg(
            F.sum("n").alias("ai_call_count"),
            resummed("c").alias("c"),
            F.min("first_call").alias("first_call"),
            F.max("last_call").alias("last_call"),
        )
        .select(
            "user_name",
            "ai_call_count",
            rounded(F.col("c"), 4).alias("total_ai_credits"),
            rounded(ratio(F.col("c"), F.col("ai_call_count")), 6).alias(
                "avg_credits_per_call"
            ),
            "first_call",
            "last_call",
            dollars(F.col("c"), price).alias("est_dollars"),
        )
        .orderBy(F.desc_nulls_first("total_ai_credits"), "user_name")
    )


def explode_roles(calls: DataFrame, split: bool = False) -> DataFrame:
    """One row per call and role; calls without roles drop out.

    ``split`` divides the credits among the roles, so that role totals add up
    to true spend.
    """
    spent = credit("credits")
    if split:
        spent = ratio(spent, F.size("role_names")).cast("decimal(38,18)")
    return calls.select(
        "function_name",
        spent.alias("credits"),
        F.explode("role_names").alias("role_name"),
    )


def spend_by_role(calls, as_of, days=30, split=False, price=PRICE_PER_CREDIT) -> DataFrame:
    """Calls and credits per role and function; a call counts once per role."""
    return (
        explode_roles(recent(calls, "start_time", as_of, days=days), split)
        .groupBy("role_name", "function_name")
        .agg(F.count(F.lit(1)).alias("calls"), F.sum("credits").alias("c"))
        .select(
            "role_name",
            "function_name",
            "calls",
            F.col("c").cast("double").alias("total_credits"),
            dollars(F.col("c"), price).alias("est_dollars"),
        )
        .orderBy(F.desc_nulls_first("total_credits"), "role_name", "function_name")
    )


def spend_by_tag(
    usage, as_of, days=30, keep_empty=False, price=PRICE_PER_CREDIT
) -> DataFrame:
    """Spend per query tag; ``keep_empty`` makes the empty tag one of them."""
    tag = F.col("query_tag")
    return (
        recent(usage, "usage_time", as_of, days=days)
        .where(tag.isNotNull() if keep_empty else is_tagged(tag))
        .groupBy("query_tag")
        .agg(total("token_credits").alias("c"), F.count(F.lit(1)).alias("call_count"))
        .select(
            "query_tag",
            F.col("c").cast("double").alias("total_credits"),
            "call_count",
            rounded(ratio(F.col("c"), F.col("call_count")), 6).alias("avg_per_call"),
            dollars(F.col("c"), price).alias("est_dollars"),
        )
        .orderBy(F.desc_nulls_first("total_credits"), "query_tag")
    )


def top_calls(
    calls,
    users,
    as_of,
    days=7,
    n=20,
    positive=False,
    user_like=None,
    function=None,
    price=PRICE_PER_CREDIT,
) -> DataFrame:
    """The ``n`` costliest calls with user names, joined after the cut."""
    log = recent(calls, "start_time", as_of, days=days)
    if positive:
        log = log.where(F.col("credits") > 0)
    if function is not None:
        log = log.where(F.col("function_name") == function)
    log = log.select(
        "query_id", "user_id", "function_name", "model_name", "credits", "start_time"
    )
    if user_like:
        log = log.join(users_like(users, user_like), "user_id", "left_semi")
    costliest = (F.desc_nulls_first("credits"), F.asc("query_id"))
    return (
        log.orderBy(*costliest)
        .limit(n)
        .join(users.select("user_id", F.col("name").alias("user_name")), "user_id", "left")
        .orderBy(*costliest)
        .select(
            "query_id",
            "user_name",
            "function_name",
            "model_name",
            rounded(credit("credits"), 6).alias("ai_credits"),
            dollars(credit("credits"), price, 4).alias("est_dollars"),
            "start_time",
        )
    )


def service_type_spend(
    metering,
    as_of=None,
    days=None,
    types: str | Sequence[str] = AI_SERVICE_TYPES,
    positive=False,
    price=PRICE_PER_CREDIT,
) -> DataFrame:
    """First and last day, billed and used credits per metering type.

    Without ``as_of`` the whole history counts.
    """
    rows = metering
    if as_of is not None:
        rows = recent(metering, "usage_date", as_of, days=days, whole_days=True)
    rows = rows.where(of_types(types))
    if positive:
        rows = rows.where(F.col("credits_billed") > 0)
    return (
        rows.groupBy("service_type")
        .agg(
            F.min("usage_date").alias("first_seen"),
            F.max("usage_date").alias("last_seen"),
            total("credits_billed").alias("billed"),
            total("credits_used").alias("used"),
        )
        .select(
            "service_type",
            "first_seen",
            "last_seen",
            F.col("billed").cast("double").alias("total_credits_billed"),
            F.col("used").cast("double").alias("total_credits_used"),
            dollars(F.col("billed"), price).alias("est_dollars"),
        )
        .orderBy(F.desc_nulls_first("total_credits_billed"), "service_type")
    )


def spend_by_team(usage, as_of, days=30) -> DataFrame:
    """Credits by the first comma part of the tag; the empty tag is one team."""
    return (
        recent(usage, "usage_time", as_of, days=days)
        .where(F.col("query_tag").isNotNull())
        .groupBy(F.split_part("query_tag", F.lit(","), F.lit(1)).alias("team_tag"))
        .agg(total("token_credits").cast("double").alias("monthly_credits"))
        .orderBy(F.desc_nulls_first("monthly_credits"), "team_tag")
    )


def tag_coverage(usage, as_of, days=30, good=90, warn=50) -> DataFrame:
    """Tagged and untagged calls, credits and share of the total, with a grade.

    Both lines come from one aggregate row, so the total needs neither a second
    scan nor a window.
    """
    tagged = is_tagged(F.col("query_tag"))
    spent = credit("token_credits")
    sides = {"Tagged": tagged, "Untagged": ~tagged}
    sums = recent(usage, "usage_time", as_of, days=days).agg(
        *[F.count(F.when(side, 1)).alias(f"{name}_calls") for name, side in sides.items()],
        *[F.sum(F.when(side, spent)).alias(f"{name}_credits") for name, side in sides.items()],
        F.sum(spent).alias("all"),
    )
    tagged_pct = F.coalesce(
        quotient(F.col("Tagged_credits"), F.col("all"), 1, times=100), dec(0)
    )
    grade = F.when(tagged_pct >= good, "good").when(tagged_pct >= warn, "warn").otherwise("bad")
    lines = [
        F.struct(
            F.lit(name).alias("attribution"),
            F.col(f"{name}_calls").alias("calls"),
            F.col(f"{name}_credits").alias("c"),
        )
        for name in sides
    ]
    return (
        sums.select("all", grade.alias("grade"), F.explode(F.array(*lines)).alias("line"))
        .where("line.calls > 0")
        .select(
            "line.attribution",
            "line.calls",
            F.col("line.c").cast("double").alias("credits"),
            quotient(F.col("line.c"), F.col("all"), 1, times=100).cast("double").alias("pct_of_total"),
            "grade",
        )
    )


def untagged_by_user(usage, users, as_of, days=30, n=20) -> DataFrame:
    """Known users with the most untagged spend; NULL and empty tags apart."""
    return (
        recent(usage, "usage_time", as_of, days=days)
        .where(~is_tagged(F.col("query_tag")))
        .groupBy("user_id", "query_tag")
        .agg(F.count(F.lit(1)).alias("calls"), total("token_credits").alias("c"))
        .join(users.select("user_id", F.col("name").alias("user_name")), "user_id")
        .groupBy("user_name", "query_tag")
        .agg(F.sum("calls").alias("calls"), F.sum("c").cast("double").alias("credits"))
        .orderBy(F.desc_nulls_first("credits"), "user_name", "query_tag")
        .limit(n)
    )


def top_spenders(usage, users, as_of, days=30, n=20) -> DataFrame:
    """Known users with the highest spend."""
    log = Usage.of(usage, SQL_LOG).window(as_of, days=days)
    return (
        log.df.groupBy("user_id")
        .agg(log.credits().alias("c"), log.calls().alias("n"), log.tokens().alias("t"))
        .join(users.select("user_id", F.col("name").alias("user_name")), "user_id")
        .groupBy("user_name")
        .agg(
            F.sum("c").cast("double").alias("total_credits"),
            F.sum("n").alias("total_calls"),
            F.sum("t").alias("total_tokens"),
        )
        .orderBy(F.desc_nulls_first("total_credits"), "user_name")
        .limit(n)
    )


def spend_by_tag_key(usage, key, as_of, days=30, price=PRICE_PER_CREDIT) -> DataFrame:
    """Spend per value of one tag key such as team, project or env."""
    return (
        recent(usage, "usage_time", as_of, days=days)
        .groupBy(tag_value(F.col("query_tag"), key).alias("tag_value"))
        .agg(F.count(F.lit(1)).alias("calls"), total("token_credits").alias("c"))
        .where(F.col("tag_value").isNotNull())
        .select(
            "tag_value",
            "calls",
            F.col("c").cast("double").alias("total_credits"),
            dollars(F.col("c"), price).alias("est_dollars"),
        )
        .orderBy(F.desc_nulls_first("total_credits"), "tag_value")
    )
