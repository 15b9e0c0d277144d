"""Queries and oracles of the attribution reports."""

from checks.catalog import query
from checks.sql import (
    AI_TYPES,
    average,
    credits,
    dollars,
    half_up,
    last,
    last_dates,
    nano,
    nano_of,
)
from pyspark.sql import functions as F
from spendlens.operators import attribution
from spendlens.plans.rollup import hourly_rollup
from checks.fixtures import AS_OF

SPEND_BY_USER = f"""
SELECT u.name AS user_name, count(*) AS ai_call_count, {half_up(nano('credits'), '1000000000', 4)} AS total_ai_credits,
  {average('credits', 6)} AS avg_credits_per_call, min(start_time) AS first_call, max(start_time) AS last_call,
  {dollars('credits')} AS est_dollars
FROM ai_function_usage c LEFT JOIN users u ON c.user_id = u.user_id
WHERE {last('start_time', 7)} GROUP BY u.name"""


@query("spend_by_user", SPEND_BY_USER)
def _(t):
    return attribution.spend_by_user(t.ai_function_usage, t.users, AS_OF)


@query("spend_by_user_from_rollup", SPEND_BY_USER)
def _(t):
    rollup = hourly_rollup(t.ai_function_usage, "start_time", "credits")
    return attribution.spend_by_user(rollup, t.users, AS_OF)


# Roles by event type, spelled as a join instead of an array.
ROLES = """roles AS (SELECT * FROM (VALUES
  ('click', 'ANALYST_ROLE', 2), ('click', 'DEV_ROLE', 2), ('view', 'PROD_PIPELINE_ROLE', 1), ('signup', 'DEV_ROLE', 1),
  ('purchase', 'DATA_SCIENCE_ROLE', 3), ('purchase', 'PROD_PIPELINE_ROLE', 3), ('purchase', 'ANALYST_ROLE', 3)
  ) AS r(event_type, role_name, n_roles)),
role_calls AS (
  SELECT c.*, r.role_name, r.n_roles FROM ai_function_usage c
  JOIN events e ON c.query_id = concat('q', CAST(e.event_id AS VARCHAR)) JOIN roles r ON e.event_type = r.event_type)"""


@query(
    "spend_by_role",
    f"""
SELECT role_name, function_name, count(*) AS calls, {credits('credits')} AS total_credits, {dollars('credits')} AS est_dollars
FROM role_calls WHERE {last('start_time', 30)} GROUP BY 1, 2""",
    ROLES,
)
def _(t):
    return attribution.spend_by_role(t.ai_function_usage, AS_OF)


@query(
    "spend_by_role_split",
    f"""
SELECT role_name, function_name, count(*) AS calls,
  {half_up(f'sum({nano_of("credits")} * 6 // n_roles)', '6000000000', 6)} AS total_credits,
  {half_up(f'3 * sum({nano_of("credits")} * 6 // n_roles)', '6000000000', 2)} AS est_dollars
FROM role_calls WHERE {last('start_time', 30)} GROUP BY 1, 2""",
    ROLES,
)
def _(t):
    split = attribution.spend_by_role(t.ai_function_usage, AS_OF, split=True)
    exact = F.col("total_credits").cast("decimal(28,12)")
    return split.withColumn("total_credits", F.round(exact, 6).cast("double"))


def _by_tag(condition):
    return f"""
SELECT query_tag, {credits('token_credits')} AS total_credits, count(*) AS call_count,
  {average('token_credits', 6)} AS avg_per_call, {dollars('token_credits')} AS est_dollars
FROM ai_sql_usage WHERE {last('usage_time', 30)} AND query_tag IS NOT NULL {condition} GROUP BY 1"""


@query("spend_by_tag", _by_tag("AND query_tag <> ''"))
def _(t):
    return attribution.spend_by_tag(t.ai_sql_usage, AS_OF)


@query("spend_by_tag_with_empty", _by_tag(""))
def _(t):
    return attribution.spend_by_tag(t.ai_sql_usage, AS_OF, keep_empty=True)


def _top_calls(condition):
    return f"""
SELECT c.query_id, u.name AS user_name, c.function_name, c.model_name,
  {half_up(nano_of('c.credits'), '1000000000', 6)} AS ai_credits,
  {half_up('3 * ' + nano_of('c.credits'), '1000000000', 4)} AS est_dollars, c.start_time
FROM ai_function_usage c LEFT JOIN users u ON c.user_id = u.user_id
WHERE {last('c.start_time', 7)} {condition} ORDER BY c.credits DESC, c.query_id LIMIT 20"""


@query("top_calls", _top_calls(""))
def _(t):
    return attribution.top_calls(t.ai_function_usage, t.users, AS_OF)


@query(
    "top_calls_filtered",
    _top_calls("AND c.credits > 0 AND u.name ILIKE '%7%' AND c.function_name = 'AI_CLASSIFY'"),
)
def _(t):
    return attribution.top_calls(
        t.ai_function_usage,
        t.users,
        AS_OF,
        positive=True,
        user_like="7",
        function="AI_CLASSIFY",
    )


def _service_types(condition):
    return f"""
SELECT service_type, min(usage_date) AS first_seen, max(usage_date) AS last_seen,
  {credits('credits_billed')} AS total_credits_billed, {credits('credits_used')} AS total_credits_used,
  {dollars('credits_billed')} AS est_dollars
FROM metering_daily WHERE service_type IN {AI_TYPES} {condition} GROUP BY 1"""


@query("service_type_spend", _service_types(""))
def _(t):
    return attribution.service_type_spend(t.metering_daily)


@query(
    "service_type_spend_recent",
    _service_types(f"AND credits_billed > 0 AND {last_dates('usage_date', 7)}"),
)
def _(t):
    return attribution.service_type_spend(t.metering_daily, AS_OF, days=7, positive=True)


@query(
    "spend_by_team",
    f"""
SELECT split_part(query_tag, ',', 1) AS team_tag, {credits('token_credits')} AS monthly_credits
FROM ai_sql_usage WHERE {last('usage_time', 30)} AND query_tag IS NOT NULL GROUP BY 1""",
)
def _(t):
    return attribution.spend_by_team(t.ai_sql_usage, AS_OF)


def _coverage(days):
    return f"""
SELECT attribution, count(*) AS calls, {credits('token_credits')} AS credits,
  {half_up('100 * ' + nano('token_credits'), 'max(total)', 1)} AS pct_of_total,
  max(CASE WHEN 1000 * tagged >= 899.5 * total THEN 'good' WHEN 1000 * tagged >= 499.5 * total THEN 'warn' ELSE 'bad' END) AS grade
FROM (SELECT *, CASE WHEN coalesce(query_tag, '') <> '' THEN 'Tagged' ELSE 'Untagged' END AS attribution
      FROM ai_sql_usage WHERE {last('usage_time', days)}) marked,
  (SELECT {nano('token_credits')} AS total,
     sum(CASE WHEN query_tag > '' THEN {nano_of('token_credits')} ELSE 0 END) AS tagged
   FROM ai_sql_usage WHERE {last('usage_time', days)}) whole
GROUP BY attribution"""


@query("tag_coverage", _coverage(30))
def _(t):
    return attribution.tag_coverage(t.ai_sql_usage, AS_OF)


@query("tag_coverage_week", _coverage(7))
def _(t):
    return attribution.tag_coverage(t.ai_sql_usage, AS_OF, days=7)


@query(
    "untagged_by_user",
    f"""
SELECT u.name AS user_name, h.query_tag, count(*) AS calls, {credits('token_credits')} AS credits
FROM ai_sql_usage h JOIN users u ON h.user_id = u.user_id
WHERE {last('usage_time', 30)} AND (h.query_tag IS NULL OR h.query_tag = '')
GROUP BY 1, 2 ORDER BY credits DESC, user_name, query_tag NULLS FIRST LIMIT 20""",
)
def _(t):
    return attribution.untagged_by_user(t.ai_sql_usage, t.users, AS_OF)


@query(
    "top_spenders",
    f"""
SELECT u.name AS user_name, {credits('token_credits')} AS total_credits, count(*) AS total_calls,
  CAST(sum(tokens) AS BIGINT) AS total_tokens
FROM ai_sql_usage h JOIN users u ON h.user_id = u.user_id
WHERE {last('usage_time', 30)} GROUP BY 1 ORDER BY total_credits DESC, user_name LIMIT 20""",
)
def _(t):
    return attribution.top_spenders(t.ai_sql_usage, t.users, AS_OF)


# The fixture writes its tags in a fixed order, so position can stand for the key.
def _tag_key(position):
    return f"""
SELECT split_part(split_part(query_tag, ',', {position}), '=', 2) AS tag_value, count(*) AS calls,
  {credits('token_credits')} AS total_credits, {dollars('token_credits')} AS est_dollars
FROM ai_sql_usage WHERE {last('usage_time', 30)} AND query_tag LIKE 'team=%' GROUP BY 1"""


@query("spend_by_tag_key_team", _tag_key(1))
def _(t):
    return attribution.spend_by_tag_key(t.ai_sql_usage, "team", AS_OF)


@query("spend_by_tag_key_project", _tag_key(2))
def _(t):
    return attribution.spend_by_tag_key(t.ai_sql_usage, "project", AS_OF)


@query("spend_by_tag_key_env", _tag_key(3))
def _(t):
    return attribution.spend_by_tag_key(t.ai_sql_usage, "env", AS_OF)
