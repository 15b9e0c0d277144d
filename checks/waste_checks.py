"""Queries and oracles of the waste reports."""

from checks.catalog import query
from checks.sql import (
    TODAY,
    average,
    credits,
    dollars,
    half_up,
    last,
    last_dates,
    nano,
    nano_of,
)
from checks.attribution_checks import ROLES
from pyspark.sql import functions as F
from spendlens.operators import waste
from spendlens.plans.rollup import hourly_rollup
from checks.fixtures import AS_OF

PER_MILLION = half_up("1000000 * " + nano("token_credits"), "1000000000 * sum(tokens)", 2)

RATE_PER_MILLION = f"""
SELECT model_name, function_name, CAST(sum(tokens) AS BIGINT) AS total_tokens,
  {credits('token_credits')} AS total_credits, {PER_MILLION} AS credits_per_1m_tokens
FROM ai_sql_usage WHERE {last('usage_time', 30)} GROUP BY 1, 2"""


@query("rate_per_million", RATE_PER_MILLION)
def _(t):
    return waste.rate_per_million(t.ai_sql_usage, AS_OF)


@query("rate_per_million_from_rollup", RATE_PER_MILLION)
def _(t):
    rollup = hourly_rollup(t.ai_sql_usage, "usage_time", "token_credits")
    return waste.rate_per_million(rollup, AS_OF)


@query(
    "model_tiers",
    f"""
SELECT model_name, count(*) AS total_calls, CAST(sum(tokens) AS BIGINT) AS total_tokens,
  {credits('token_credits')} AS total_credits, {PER_MILLION} AS credits_per_1m_tokens,
  {dollars('token_credits')} AS est_dollars,
  CASE WHEN {nano('token_credits')} < 2000 * sum(tokens) THEN 'Budget'
    WHEN {nano('token_credits')} < 5000 * sum(tokens) THEN 'Standard' ELSE 'Premium' END AS cost_tier
FROM ai_sql_usage WHERE {last('usage_time', 30)} GROUP BY 1""",
)
def _(t):
    return waste.model_tiers(t.ai_sql_usage, AS_OF)


def _audit(condition, days=30):
    return f"""
SELECT function_name, model_name, count(*) AS call_count, {credits('credits')} AS total_credits,
  {average('credits', 6)} AS avg_credits_per_call, {dollars('credits')} AS est_dollars
FROM ai_function_usage WHERE {last('start_time', days)} {condition} GROUP BY 1, 2"""


@query("completion_audit", _audit("AND function_name IN ('COMPLETE', 'AI_COMPLETE')"))
def _(t):
    return waste.completion_audit(t.ai_function_usage, AS_OF)


@query("completion_audit_all_functions", _audit(""))
def _(t):
    return waste.completion_audit(t.ai_function_usage, AS_OF, functions=None)


@query("completion_audit_after_migration", _audit("AND function_name = 'AI_COMPLETE'", 7))
def _(t):
    return waste.completion_audit(
        t.ai_function_usage, AS_OF, days=7, functions=("AI_COMPLETE",)
    )


@query(
    "duplicate_calls_by_user",
    f"""
SELECT h.user_id, u.name, h.function_name, CAST(date_trunc('day', start_time) AS TIMESTAMP) AS day,
  count(*) AS daily_calls, {credits('credits')} AS daily_credits
FROM ai_function_usage h JOIN users u ON h.user_id = u.user_id
WHERE {last('start_time', 7)} GROUP BY 1, 2, 3, 4 HAVING count(*) > 1""",
)
def _(t):
    return waste.duplicate_calls_by_user(t.ai_function_usage, t.users, AS_OF, more_than=1)


@query(
    "duplicate_calls_by_tag",
    f"""
SELECT query_tag, function_name, count(*) AS repetitions, {credits('token_credits')} AS total_credits,
  min(usage_time) AS first_call, max(usage_time) AS last_call
FROM ai_sql_usage WHERE {last('usage_time', 7)} GROUP BY 1, 2 HAVING count(*) > 10""",
)
def _(t):
    return waste.duplicate_calls_by_tag(t.ai_sql_usage, AS_OF)


@query(
    "prompt_trend",
    f"""
SELECT function_name, CAST(date_trunc('week', usage_time) AS TIMESTAMP) AS week,
  CAST(sum(tokens) AS DOUBLE) / count(*) AS avg_tokens_per_call, {credits('token_credits')} AS weekly_credits,
  count(*) AS call_count
FROM ai_sql_usage WHERE {last('usage_time', 60)} GROUP BY 1, 2""",
)
def _(t):
    return waste.prompt_trend(t.ai_sql_usage, AS_OF)


def _high_tokens(days, condition):
    return f"""
SELECT query_id, model_name, function_name, tokens, CAST(token_credits AS DOUBLE) AS token_credits, usage_time
FROM ai_sql_usage WHERE {last('usage_time', days)} {condition} ORDER BY tokens DESC, query_id LIMIT 20"""


@query("high_token_calls", _high_tokens(7, "AND tokens > 50000"))
def _(t):
    return waste.high_token_calls(t.ai_sql_usage, AS_OF)


@query("high_token_calls_month", _high_tokens(30, ""))
def _(t):
    return waste.high_token_calls(t.ai_sql_usage, AS_OF, days=30, over=None)


@query(
    "granular_breakdown",
    f"""
SELECT query_id, model_name, tokens, CAST(token_credits AS DOUBLE) AS token_credits, input_tokens, output_tokens,
  reasoning_tokens, CAST(input_credits AS DOUBLE) AS input_credits, CAST(output_credits AS DOUBLE) AS output_credits,
  CAST(reasoning_credits AS DOUBLE) AS reasoning_credits
FROM ai_sql_usage q WHERE {last('usage_time', 7)} ORDER BY q.token_credits DESC, query_id LIMIT 20""",
)
def _(t):
    return waste.granular_breakdown(t.ai_sql_usage, AS_OF)


def _idle(standing):
    idx = f"sum(CASE WHEN consumption_type IN {standing} THEN {nano_of('credits')} ELSE 0 END)"
    qry = f"sum(CASE WHEN consumption_type = 'QUERY' THEN {nano_of('credits')} ELSE 0 END)"
    return f"""
SELECT service_name, CAST({idx} AS DOUBLE) / 1e9 AS idx_credits, CAST({qry} AS DOUBLE) / 1e9 AS qry_credits,
  {half_up('100 * ' + qry, idx, 1)} AS query_pct
FROM search_daily_usage WHERE {last_dates('usage_date', 30)} GROUP BY 1 HAVING {idx} > 0"""


@query("idle_services", _idle("('INDEXING')"))
def _(t):
    return waste.idle_services(t.search_daily_usage, AS_OF)


@query("idle_services_with_serving", _idle("('INDEXING', 'SERVING')"))
def _(t):
    return waste.idle_services(
        t.search_daily_usage, AS_OF, standing_types=("INDEXING", "SERVING")
    )


@query(
    "service_detail",
    f"""
SELECT service_name, database_name, schema_name, consumption_type, {credits('credits')} AS total_credits,
  CAST(sum(tokens) AS BIGINT) AS total_tokens, min(usage_date) AS first_usage, max(usage_date) AS last_usage
FROM search_daily_usage WHERE {last_dates('usage_date', 30)} GROUP BY 1, 2, 3, 4""",
)
def _(t):
    return waste.service_detail(t.search_daily_usage, AS_OF)


@query(
    "cleanup_candidates",
    f"""
SELECT service_name, last_query_date, CAST({TODAY} - last_query_date AS INTEGER) AS days_since_last_query,
  indexing_credits_wasted
FROM (SELECT service_name, max(usage_date) FILTER (WHERE consumption_type = 'QUERY') AS last_query_date,
        CAST(coalesce(sum({nano_of('credits')}) FILTER (WHERE consumption_type = 'INDEXING'), 0) AS DOUBLE) / 1e9
          AS indexing_credits_wasted
      FROM search_daily_usage WHERE {last_dates('usage_date', 30)} GROUP BY 1) per_service
WHERE last_query_date IS NULL OR {TODAY} - last_query_date > 14""",
)
def _(t):
    return waste.cleanup_candidates(t.search_daily_usage, AS_OF)


@query(
    "indexing_by_service",
    f"""
SELECT service_name, {credits('credits')} AS monthly_credits FROM search_daily_usage
WHERE {last_dates('usage_date', 30)} AND consumption_type = 'INDEXING' GROUP BY 1""",
)
def _(t):
    return waste.indexing_by_service(t.search_daily_usage, AS_OF)


@query(
    "call_cost_gap",
    f"""
SELECT CAST(date_trunc('day', usage_time) AS TIMESTAMP) AS day, CAST(max(token_credits) AS DOUBLE) AS max_call,
  {credits('token_credits')} / count(*) AS avg_call, count(*) AS total_calls
FROM ai_sql_usage WHERE {last('usage_time', 14)} GROUP BY 1""",
)
def _(t):
    return waste.call_cost_gap(t.ai_sql_usage, AS_OF)


@query(
    "heavy_call_users",
    f"""
SELECT u.name AS user_name, count(*) AS total_calls, {credits('token_credits')} AS total_credits,
  {credits('token_credits')} / count(*) AS avg_credits_per_call, CAST(max(token_credits) AS DOUBLE) AS max_single_call
FROM ai_sql_usage h JOIN users u ON h.user_id = u.user_id
WHERE {last('usage_time', 7)} GROUP BY 1 HAVING {nano('token_credits')} > 10000000 * count(*)""",
)
def _(t):
    return waste.heavy_call_users(t.ai_sql_usage, t.users, AS_OF)


@query(
    "usage_by_hour_of_day",
    f"""
SELECT u.name AS user_name, hour(usage_time) AS hour_of_day, count(*) AS calls, {credits('token_credits')} AS credits
FROM ai_sql_usage h JOIN users u ON h.user_id = u.user_id
WHERE {last('usage_time', 30)} GROUP BY 1, 2 ORDER BY credits DESC, user_name, hour_of_day LIMIT 30""",
)
def _(t):
    return waste.usage_by_hour_of_day(t.ai_sql_usage, t.users, AS_OF)


@query(
    "role_like_spend",
    f"""
SELECT role_name, {credits('credits')} AS credits FROM role_calls
WHERE {last('start_time', 7)} AND role_name ILIKE '%DEV%' GROUP BY 1""",
    ROLES,
)
def _(t):
    return waste.role_like_spend(t.ai_function_usage, AS_OF)


# Service sizes from the search log: 4 bytes per token, and the share of the 30
# days on which the service served.
SIZES = f"""sizes AS (
SELECT service_name, sum(tokens) * 4 AS kb, count(DISTINCT CASE WHEN consumption_type = 'SERVING' THEN usage_date END) AS served
FROM search_daily_usage WHERE {last_dates('usage_date', 30)} GROUP BY 1)"""


@query(
    "standing_cost",
    f"""
SELECT service_name, CAST(kb AS DOUBLE) / 1e6 AS gb, {half_up('served', '30', 4)} AS resumed_share,
  {half_up('63 * kb * ((2 * served * 10000 + 30) // 60)', '100000000000', 4)} AS monthly_credits,
  {half_up('3 * 63 * kb * ((2 * served * 10000 + 30) // 60)', '100000000000', 2)} AS est_dollars
FROM sizes""",
    SIZES,
)
def _(t):
    sizes = waste.service_sizes(t.search_daily_usage, AS_OF)
    return waste.standing_cost(sizes)


# Cheaper functions and their savings in percent.
ALTERNATIVES = """alternatives AS (SELECT * FROM (VALUES
  ('sentiment', 'AI_COMPLETE', 'AI_SENTIMENT', 40, 70), ('classification', 'AI_COMPLETE', 'AI_CLASSIFY', 50, 75),
  ('extraction', 'AI_COMPLETE', 'AI_EXTRACT', 30, 60), ('filtering', 'AI_COMPLETE', 'AI_FILTER', 50, 70),
  ('translation', 'AI_COMPLETE', 'AI_TRANSLATE', 40, 60)) AS a(task, generic, specific, low, high))"""


@query(
    "rightsizing_savings",
    f"""
SELECT a.task, a.generic, c.model_name, a.specific, {credits('credits')} AS credits,
  {half_up('max(a.low) * ' + nano('credits'), '100000000000', 4)} AS low_saving,
  {half_up('max(a.high) * ' + nano('credits'), '100000000000', 4)} AS high_saving,
  {half_up('3 * max(a.low) * ' + nano('credits'), '100000000000', 2)} AS low_dollars,
  {half_up('3 * max(a.high) * ' + nano('credits'), '100000000000', 2)} AS high_dollars
FROM ai_function_usage c JOIN alternatives a ON c.function_name = a.generic
WHERE {last('c.start_time', 30)} GROUP BY 1, 2, 3, 4""",
    ALTERNATIVES,
)
def _(t):
    return waste.rightsizing_savings(t.ai_function_usage, AS_OF)


# Model switches and their savings in percent.
SWITCHES = """switches(task, model, cheaper, low, high) AS (VALUES
  ('summarization', 'claude-4-sonnet', 'mistral-7b', 30, 60), ('summarization', 'llama3.1-405b', 'mistral-7b', 30, 60),
  ('summarization', 'mistral-large', 'mistral-7b', 30, 60), ('right-sizing', 'claude-4-sonnet', 'mistral-7b', 90, 98))"""


@query(
    "model_switch_savings",
    f"""
SELECT s.task, c.function_name, c.model_name, s.cheaper AS cheaper_model, {credits('credits')} AS credits,
  {half_up('max(s.low) * ' + nano('credits'), '100000000000', 4)} AS low_saving,
  {half_up('max(s.high) * ' + nano('credits'), '100000000000', 4)} AS high_saving,
  {half_up('3 * max(s.low) * ' + nano('credits'), '100000000000', 2)} AS low_dollars,
  {half_up('3 * max(s.high) * ' + nano('credits'), '100000000000', 2)} AS high_dollars
FROM ai_function_usage c JOIN switches s ON c.model_name = s.model
WHERE c.function_name IN ('AI_COMPLETE', 'COMPLETE') AND {last('c.start_time', 30)} GROUP BY 1, 2, 3, 4""",
    SWITCHES,
)
def _(t):
    return waste.model_switch_savings(t.ai_function_usage, AS_OF)
