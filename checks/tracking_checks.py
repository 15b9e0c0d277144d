"""Queries and oracles of the spend tracking reports."""

from checks.catalog import query, run_folder
from checks.sql import (
    AI_TEXT,
    NOW,
    average,
    credits,
    dollars,
    half_up,
    last,
    last_dates,
    nano,
    nano_of,
    rounded,
)
from pyspark.sql import functions as F
from spendlens.operators import tracking
from spendlens.plans.distinct import bitmaps_within, distinct_users, user_bitmaps
from spendlens.plans.rollup import hourly_rollup
from checks.fixtures import AS_OF
from spendlens.sources.ingest import ingest
from spendlens.sources.logs import read_log

USER_TEXT = "7"
KNOWN = f"(SELECT user_id FROM users WHERE name LIKE '%{USER_TEXT}%')"

SPEND_BY_FUNCTION = f"""
SELECT function_name, count(*) AS call_count, {rounded('credits', 4)} AS total_ai_credits,
  {average('credits', 6)} AS avg_credits_per_call,
  {half_up(nano_of('min(credits)'), '1000000000', 6)} AS min_credits,
  {half_up(nano_of('max(credits)'), '1000000000', 6)} AS max_credits,
  {dollars('credits')} AS est_dollars
FROM ai_function_usage WHERE {last('start_time', 7)} GROUP BY function_name"""


@query("spend_by_function", SPEND_BY_FUNCTION)
def _(t):
    return tracking.spend_by_function(t.ai_function_usage, AS_OF)


@query("spend_by_function_from_rollup", SPEND_BY_FUNCTION)
def _(t):
    rollup = hourly_rollup(t.ai_function_usage, "start_time", "credits")
    return tracking.spend_by_function(rollup, AS_OF)


@query(
    "hourly_rollup_functions",
    f"""
SELECT date_trunc('hour', start_time) AS hour, user_id, function_name, model_name, count(*) AS calls,
  {credits('credits')} AS credits_sum, CAST(min(credits) AS DOUBLE) AS credits_min,
  CAST(max(credits) AS DOUBLE) AS credits_max, min(start_time) AS first_time, max(start_time) AS last_time,
  CAST(min(start_time) AS DATE) AS event_date
FROM ai_function_usage GROUP BY 1, 2, 3, 4""",
)
def _(t):
    rollup = hourly_rollup(t.ai_function_usage, "start_time", "credits").drop("tokens_sum")
    return rollup.withColumns(
        {c: F.col(c).cast("double") for c in ("credits_sum", "credits_min", "credits_max")}
    )


@query(
    "hourly_rollup_sql",
    f"""
SELECT date_trunc('hour', usage_time) AS hour, user_id, function_name, model_name, count(*) AS calls,
  {credits('token_credits')} AS credits_sum, CAST(min(token_credits) AS DOUBLE) AS credits_min,
  CAST(max(token_credits) AS DOUBLE) AS credits_max, CAST(sum(tokens) AS BIGINT) AS tokens_sum,
  min(usage_time) AS first_time, max(usage_time) AS last_time, CAST(min(usage_time) AS DATE) AS event_date
FROM ai_sql_usage GROUP BY 1, 2, 3, 4""",
)
def _(t):
    rollup = hourly_rollup(t.ai_sql_usage, "usage_time", "token_credits")
    return rollup.withColumns(
        {c: F.col(c).cast("double") for c in ("credits_sum", "credits_min", "credits_max")}
    )


@query(
    "model_cost_comparison",
    f"""
SELECT model_name, function_name, count(*) AS calls, {rounded('credits', 4)} AS total_ai_credits,
  {average('credits', 6)} AS credits_per_call, {dollars('credits')} AS est_dollars
FROM ai_function_usage WHERE {last('start_time', 48, 'HOUR')} AND function_name IN ('COMPLETE', 'AI_COMPLETE')
GROUP BY 1, 2""",
)
def _(t):
    return tracking.model_cost_comparison(t.ai_function_usage, AS_OF, hours=48)


@query(
    "hourly_spend",
    f"""
SELECT date_trunc('hour', start_time) AS hour_bucket, function_name, count(*) AS ai_calls,
  {rounded('credits', 4)} AS ai_credits, {dollars('credits')} AS est_dollars
FROM ai_function_usage WHERE {last('start_time', 1)} GROUP BY 1, 2""",
)
def _(t):
    return tracking.hourly_spend(t.ai_function_usage, AS_OF)


def _hourly(join):
    return f"""
SELECT date_trunc('hour', start_time) AS hour_bucket, count(*) AS queries,
  coalesce({rounded('credits', 4)}, 0.0) AS credits
FROM ai_function_usage c {join} {last('start_time', 7)} GROUP BY 1"""


@query("hourly_trend", _hourly("WHERE"))
def _(t):
    return tracking.hourly_trend(t.ai_function_usage, AS_OF)


@query(
    "hourly_trend_of_users",
    _hourly(f"LEFT JOIN users u ON c.user_id = u.user_id WHERE u.name ILIKE '%{USER_TEXT}%' AND"),
)
def _(t):
    return tracking.hourly_trend(t.ai_function_usage, AS_OF, users=t.users, user_like=USER_TEXT)


@query(
    "recent_ai_queries",
    f"""
SELECT query_id, substr(query_text, 1, 120) AS query_preview, start_time,
  {half_up('total_elapsed_time', '1000', 2)} AS seconds,
  {half_up(nano_of('credits_used_cloud_services'), '1000000000', 6)} AS credits_used
FROM query_history WHERE {last('start_time', 1, 'HOUR')} AND user_name = 'user_7' AND {AI_TEXT}""",
)
def _(t):
    return tracking.recent_ai_queries(t.query_history, "user_7", AS_OF)


@query(
    "latest_ai_queries",
    f"""
SELECT query_id, substr(query_text, 1, 100) AS query_preview, start_time,
  CAST(total_elapsed_time AS DOUBLE) / 1000.0 AS seconds
FROM (SELECT * FROM query_history WHERE start_time <= {NOW} ORDER BY start_time DESC, query_id LIMIT 50) newest
WHERE {AI_TEXT}""",
)
def _(t):
    return tracking.latest_ai_queries(t.query_history, AS_OF)


@query(
    "quota_status",
    f"""
SELECT name AS monitor_name, CAST(credit_quota AS DOUBLE) AS credit_quota,
  {half_up(nano_of('credits_used'), '1000000000', 2)} AS credits_used,
  {half_up('100 * ' + nano_of('credits_used'), nano_of('credit_quota'), 2)} AS pct_used,
  {half_up(nano_of('credits_used_compute'), '1000000000', 2)} AS credits_used_compute,
  {half_up(nano_of('credits_used_cloud_services'), '1000000000', 4)} AS credits_used_cloud_services
FROM quota_monitors""",
)
def _(t):
    return tracking.quota_status(t.quota_monitors)


@query(
    "recent_call_costs",
    f"""
SELECT query_id, function_name, model_name, {half_up(nano_of('credits'), '1000000000', 6)} AS ai_credits, start_time
FROM ai_function_usage WHERE {last('start_time', 1, 'HOUR')} ORDER BY start_time DESC, query_id LIMIT 10""",
)
def _(t):
    return tracking.recent_call_costs(t.ai_function_usage, AS_OF)


PURCHASES = "query_id IN (SELECT concat('q', CAST(event_id AS VARCHAR)) FROM events WHERE event_type = 'purchase')"


def _purchase_ids(t):
    purchases = t.events.where("event_type = 'purchase'")
    return purchases.select(F.concat(F.lit("q"), F.col("event_id").cast("string")).alias("query_id"))


@query(
    "project_cost",
    f"""
SELECT {credits('credits')} AS sample_credits, count(*) AS sample_calls,
  {average('credits', 6)} AS credits_per_call,
  {half_up('100 * ' + nano('credits'), '1000000000', 4)} AS projected_500_rows,
  {half_up('10000 * ' + nano('credits'), '1000000000', 2)} AS projected_50k_rows,
  {half_up('100000 * ' + nano('credits'), '1000000000', 2)} AS projected_500k_rows,
  {half_up('300000 * ' + nano('credits'), '1000000000', 2)} AS projected_500k_dollars
FROM ai_function_usage WHERE {PURCHASES}""",
)
def _(t):
    return tracking.project_cost(t.ai_function_usage, _purchase_ids(t))


@query(
    "project_to_rows",
    f"""
SELECT target_rows, {half_up('c', '1000000000 * n', 6)} AS credits_per_row,
  {half_up('c * target_rows', '1000000000 * n', 4)} AS projected_credits,
  {half_up('3 * c * target_rows', '1000000000 * n', 2)} AS projected_dollars
FROM (SELECT {nano('credits')} AS c, count(*) AS n FROM ai_function_usage WHERE {PURCHASES}) sample,
  (SELECT CAST(unnest([500, 5000, 50000, 500000, 1000000]) AS BIGINT) AS target_rows) targets""",
)
def _(t):
    return tracking.project_to_rows(t.ai_function_usage, _purchase_ids(t))


def _assistant_daily(view):
    return f"""
SELECT user_name, CAST(date_trunc('day', event_timestamp) AS TIMESTAMP) AS usage_date, count(*) AS sessions,
  CAST(sum(total_tokens) AS BIGINT) AS total_tokens, {rounded('total_credits', 4)} AS total_credits,
  {dollars('total_credits')} AS est_dollars
FROM {view} WHERE {last('event_timestamp', 7)} GROUP BY 1, 2"""


@query("assistant_daily_cli", _assistant_daily("assistant_cli_usage"))
def _(t):
    return tracking.assistant_daily(t.assistant_cli_usage, AS_OF)


@query("assistant_daily_web", _assistant_daily("assistant_web_usage"))
def _(t):
    return tracking.assistant_daily(t.assistant_web_usage, AS_OF)


@query(
    "assistant_metering",
    f"""
SELECT service_type, usage_date, {credits('credits_billed')} AS credits_billed, {credits('credits_used')} AS credits_used
FROM metering_daily WHERE service_type IN ('CORTEX_CODE_CLI', 'CORTEX_CODE_SNOWSIGHT')
  AND {last_dates('usage_date', 30)} GROUP BY 1, 2""",
)
def _(t):
    return tracking.assistant_metering(t.metering_daily, AS_OF)


@query(
    "assistant_top_users",
    f"""
SELECT user_name, CAST(sum(total_tokens) AS BIGINT) AS total_tokens, {rounded('total_credits', 4)} AS total_credits,
  {dollars('total_credits')} AS est_dollars, count(*) AS total_sessions
FROM (SELECT * FROM assistant_cli_usage UNION ALL SELECT * FROM assistant_web_usage) both_surfaces
WHERE {last('event_timestamp', 30)} GROUP BY user_name""",
)
def _(t):
    return tracking.assistant_top_users(t.assistant_cli_usage, t.assistant_web_usage, AS_OF)


BY_MODEL = """by_model AS (
SELECT user_name, event_timestamp, model_name AS model, input_tokens, output_tokens, total_tokens, total_credits,
  CASE WHEN request_id % 5 = 0 THEN 2 ELSE 1 END AS models
FROM assistant_cli_usage
UNION ALL
SELECT user_name, event_timestamp, 'mistral-7b', input_tokens % 50, output_tokens % 20, total_tokens, total_credits, 2
FROM assistant_cli_usage WHERE request_id % 5 = 0)"""


@query(
    "assistant_by_user_model",
    f"""
SELECT user_name, model AS model_name, {credits('total_credits')} AS total_credits,
  {dollars('total_credits', 4)} AS est_cost_usd
FROM by_model WHERE {last('event_timestamp', 30)} GROUP BY 1, 2""",
    BY_MODEL,
)
def _(t):
    return tracking.assistant_by_user_model(t.assistant_cli_usage, AS_OF)


@query(
    "assistant_by_user_model_split",
    f"""
SELECT user_name, model AS model_name,
  CAST(sum({nano_of('total_credits')} * 2 // models) AS DOUBLE) / 2e9 AS total_credits,
  {half_up(f'3 * sum({nano_of("total_credits")} * 2 // models)', '2000000000', 4)} AS est_cost_usd
FROM by_model WHERE {last('event_timestamp', 30)} GROUP BY 1, 2""",
    BY_MODEL,
)
def _(t):
    return tracking.assistant_by_user_model(t.assistant_cli_usage, AS_OF, split=True)


@query(
    "assistant_detail",
    """
SELECT user_name, event_timestamp, model, input_tokens, output_tokens, total_tokens AS tokens,
  CAST(total_credits AS DOUBLE) AS credits FROM by_model""",
    BY_MODEL,
)
def _(t):
    return tracking.assistant_detail(t.assistant_cli_usage)


@query(
    "daily_function_trend",
    f"""
SELECT CAST(date_trunc('day', start_time) AS TIMESTAMP) AS day, function_name, count(*) AS calls,
  {credits('credits')} AS daily_credits
FROM ai_function_usage WHERE {last('start_time', 30)} GROUP BY 1, 2""",
)
def _(t):
    return tracking.daily_function_trend(t.ai_function_usage, AS_OF)


def _kpis(condition):
    return f"""
SELECT count(*) AS total_queries, coalesce({rounded('c.credits', 4)}, 0.0) AS total_credits,
  coalesce({average('c.credits', 6)}, 0.0) AS avg_credits, count(DISTINCT u.name) AS unique_users,
  coalesce({dollars('c.credits')}, 0.0) AS est_dollar_cost
FROM ai_function_usage c LEFT JOIN users u ON c.user_id = u.user_id
WHERE {last('c.start_time', 7)} {condition}"""


@query("kpis", _kpis(""))
def _(t):
    return tracking.kpis(t.ai_function_usage, t.users, AS_OF)


@query("kpis_filtered", _kpis(f"AND u.name ILIKE '%{USER_TEXT}%' AND c.function_name = 'AI_COMPLETE'"))
def _(t):
    return tracking.kpis(
        t.ai_function_usage, t.users, AS_OF, user_like=USER_TEXT, function="AI_COMPLETE"
    )


@query(
    "top_functions",
    f"""
SELECT function_name AS func_name, count(*) AS calls, coalesce({rounded('credits', 4)}, 0.0) AS credits
FROM ai_function_usage WHERE {last('start_time', 7)} GROUP BY 1 HAVING sum(credits) > 0
ORDER BY credits DESC, func_name LIMIT 10""",
)
def _(t):
    return tracking.top_functions(t.ai_function_usage, AS_OF)


@query(
    "model_panel",
    f"""
SELECT model_name, count(*) AS calls, {rounded('credits', 4)} AS total_credits,
  {average('credits', 6)} AS credits_per_call
FROM ai_function_usage c WHERE {last('start_time', 7)} AND function_name IN ('COMPLETE', 'AI_COMPLETE')
  AND user_id IN {KNOWN} GROUP BY 1 HAVING sum(credits) > 0""",
)
def _(t):
    return tracking.model_panel(t.ai_function_usage, AS_OF, users=t.users, user_like=USER_TEXT)


@query(
    "distinct_users_by_function",
    f"""
SELECT function_name, count(DISTINCT user_id) AS unique_users FROM ai_function_usage
WHERE start_time >= {NOW} - INTERVAL 7 DAY AND start_time < {NOW} GROUP BY 1
UNION ALL SELECT NULL, count(DISTINCT user_id) FROM ai_function_usage
WHERE start_time >= {NOW} - INTERVAL 7 DAY AND start_time < {NOW}""",
)
def _(t):
    """Users of a week per function and of all, from hourly bitmaps."""
    week = bitmaps_within(user_bitmaps(t.ai_function_usage, "start_time"), AS_OF, days=7)
    none = F.lit(None).cast("string").alias("function_name")
    return distinct_users(week, "function_name").unionByName(distinct_users(week).select(none, "unique_users"))


@query("ingest_rounds", "SELECT query_id, user_id, CAST(credits AS DOUBLE) AS credits, start_time FROM ai_function_usage", traits=("writes",))
def _(t):
    """Three looks at a source whose calls arrive up to 45 minutes late, in any order."""
    calls = t.ai_function_usage.drop("role_names")
    lag = F.make_dt_interval(mins=F.pmod(F.xxhash64("query_id"), F.lit(45)))
    arrived = (F.col("start_time") + lag).cast("timestamp_ntz")
    path = run_folder(t.spark, "ingest")
    for until in ("2024-01-11 07:13:00", "2024-01-20 18:01:00", "2100-01-01 00:00:00"):
        seen = calls.where(arrived <= F.lit(until).cast("timestamp_ntz"))
        ingest(seen.unionByName(seen.where("user_id % 10 = 0")), path, "start_time")
    return read_log(t.spark, path).select("query_id", "user_id", F.col("credits").cast("double").alias("credits"), "start_time")
