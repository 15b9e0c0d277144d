"""Queries and oracles of the spend controls."""

from checks.catalog import query
from checks.sql import NOW, half_up, last, nano_of
from pyspark.sql import functions as F
from spendlens.functions.tags import tag_value
from spendlens.functions.text import estimate_tokens
from spendlens.operators import controls
from checks.fixtures import AS_OF

LIMIT = 0.006
CHANGED = "user_id % 10 = 3"

# Rolling sum as a self-join; every tenth user has a lower limit.
ROLLED = f"""calls AS (
SELECT 'cli' AS surface, * FROM assistant_cli_usage UNION ALL SELECT 'web', * FROM assistant_web_usage),
rolled AS (
SELECT c.surface, c.request_id, c.user_id, c.user_name, c.event_timestamp,
  max(c.total_credits) AS total_credits, sum({nano_of('p.total_credits')}) AS rolling,
  max(CASE WHEN c.{CHANGED} THEN 5000000 ELSE 6000000 END) AS cap
FROM calls c JOIN calls p ON p.user_id = c.user_id AND p.surface = c.surface
  AND p.event_timestamp BETWEEN c.event_timestamp - INTERVAL 24 HOUR AND c.event_timestamp
GROUP BY 1, 2, 3, 4, 5)"""


def _capped(t):
    calls = controls.surfaces(cli=t.assistant_cli_usage, web=t.assistant_web_usage)
    overrides = (
        calls.where(CHANGED).select("user_id").distinct().withColumn("credits", F.lit(0.005))
    )
    return controls.rolling_cap(calls, LIMIT, overrides)


@query(
    "rolling_cap",
    """
SELECT surface, request_id, user_id, user_name, event_timestamp, CAST(total_credits AS DOUBLE) AS total_credits,
  CAST(rolling AS DOUBLE) / 1e9 AS rolling_credits, CAST(cap AS DOUBLE) / 1e9 AS credit_limit, rolling > cap AS over_limit
FROM rolled""",
    ROLLED,
)
def _(t):
    money = ("total_credits", "rolling_credits", "credit_limit")
    return _capped(t).withColumns({c: F.col(c).cast("double") for c in money})


@query(
    "rolling_peaks",
    """
SELECT user_id, surface, CAST(max(rolling) AS DOUBLE) / 1e9 AS peak_credits,
  count(*) FILTER (WHERE rolling > cap) AS calls_over, min(event_timestamp) FILTER (WHERE rolling > cap) AS first_over
FROM rolled GROUP BY 1, 2""",
    ROLLED,
)
def _(t):
    return controls.rolling_peaks(_capped(t))


# Instants of a user and surface in order; each step keeps the calls of the last day that counted.
ENFORCED = f"""RECURSIVE calls AS (
SELECT 'cli' AS surface, * FROM assistant_cli_usage UNION ALL SELECT 'web', * FROM assistant_web_usage),
instants AS (
SELECT user_id, surface, event_timestamp AS moment, CAST(sum({nano_of('total_credits')}) AS BIGINT) AS c,
  CASE WHEN {CHANGED} THEN 5000000 ELSE 6000000 END AS cap,
  row_number() OVER (PARTITION BY user_id, surface ORDER BY event_timestamp) AS n
FROM calls GROUP BY 1, 2, 3),
walk AS (
SELECT user_id, surface, n, moment, cap, c > cap AS blocked,
  CASE WHEN c > cap THEN [] ELSE [{{'moment': moment, 'c': c}}] END AS kept FROM instants WHERE n = 1
UNION ALL
SELECT user_id, surface, n, moment, cap, spent + c > cap,
  CASE WHEN spent + c > cap THEN held ELSE list_append(held, {{'moment': moment, 'c': c}}) END
FROM (SELECT *, coalesce(list_sum(list_transform(held, lambda k: k.c)), 0) AS spent FROM (
  SELECT i.*, list_filter(w.kept, lambda k: k.moment >= i.moment - INTERVAL 24 HOUR) AS held
  FROM instants i JOIN walk w ON w.user_id = i.user_id AND w.surface = i.surface AND w.n = i.n - 1) a) b)"""


@query(
    "rolling_cap_enforced",
    """
SELECT c.surface, c.request_id, c.user_id, c.user_name, c.event_timestamp, CAST(c.total_credits AS DOUBLE) AS total_credits,
  CAST(coalesce(list_sum(list_transform(kept, lambda k: k.c)), 0) AS DOUBLE) / 1e9 AS rolling_credits,
  CAST(cap AS DOUBLE) / 1e9 AS credit_limit, blocked
FROM calls c JOIN walk w ON c.user_id = w.user_id AND c.surface = w.surface AND c.event_timestamp = w.moment""",
    ENFORCED,
    traits=("python",),
)
def _(t):
    calls = controls.surfaces(cli=t.assistant_cli_usage, web=t.assistant_web_usage)
    overrides = (
        calls.where(CHANGED).select("user_id").distinct().withColumn("credits", F.lit(0.005))
    )
    money = ("total_credits", "rolling_credits", "credit_limit")
    capped = controls.rolling_cap_enforced(calls, LIMIT, overrides)
    return capped.withColumns({c: F.col(c).cast("double") for c in money})


def limits_table(t, scopes):
    return t.spark.createDataFrame(list(scopes.items()), "scope string, credits bigint")


def _burn(scope, scopes):
    listed = ", ".join(f"('{name}', {credits})" for name, credits in scopes.items())
    return f"""running AS (
SELECT s.scope, s.month, s.usage_time, l.budget, sum(s.c) OVER (
    PARTITION BY s.scope, s.month ORDER BY s.usage_time RANGE UNBOUNDED PRECEDING) AS used
FROM (SELECT {scope} AS scope, CAST(date_trunc('month', usage_time) AS TIMESTAMP) AS month, usage_time,
        {nano_of('token_credits')} AS c FROM ai_sql_usage WHERE usage_time <= {NOW}) s
JOIN (VALUES {listed}) AS l(scope, budget) ON s.scope = l.scope)"""


BURN = f"""
SELECT scope, month, CAST(max(budget) AS DOUBLE) AS budget, CAST(max(used) AS DOUBLE) / 1e9 AS spend,
  {half_up('100 * max(used)', 'max(CAST(budget AS BIGINT)) * 1000000000', 1)} AS pct_used, CAST(pct AS DOUBLE) AS threshold_pct,
  min(usage_time) FILTER (WHERE used >= CAST(budget AS BIGINT) * pct * 10000000) AS crossed_at
FROM running, (VALUES (50), (75), (80), (90)) AS steps(pct) GROUP BY scope, month, pct"""

TEAM_LIMITS = {"t0": 30, "t1": 60, "t2": 5000, "t3": 45}
ACCOUNT_LIMIT = {"account": 900}


MONTH_TO_DATE = BURN + " HAVING month >= date_trunc('month', TIMESTAMP '2024-01-31')"


@query(
    "budget_burn_by_team",
    BURN,
    _burn("CASE WHEN query_tag LIKE 'team=%' THEN split_part(split_part(query_tag, ',', 1), '=', 2) END", TEAM_LIMITS),
)
def _(t):
    scope = tag_value(F.col("query_tag"), "team")
    return controls.budget_burn(
        t.ai_sql_usage, limits_table(t, TEAM_LIMITS), scope, AS_OF, months=None
    )


@query("budget_burn_account", BURN, _burn("'account'", ACCOUNT_LIMIT))
def _(t):
    return controls.budget_burn(
        t.ai_sql_usage, limits_table(t, ACCOUNT_LIMIT), F.lit("account"), AS_OF, months=None
    )


@query("budget_burn_month_to_date", MONTH_TO_DATE, _burn("'account'", ACCOUNT_LIMIT))
def _(t):
    return controls.budget_burn(
        t.ai_sql_usage, limits_table(t, ACCOUNT_LIMIT), F.lit("account"), AS_OF
    )


@query(
    "rolling_cap_untimed",
    """
SELECT surface, request_id, CAST(rolling AS DOUBLE) / 1e9 AS rolling_credits, rolling > 6000000 AS over_limit
FROM (SELECT c.surface, c.request_id,
    CASE WHEN c.at IS NOT NULL THEN sum(p.total_credits) END AS rolling
  FROM timed c LEFT JOIN timed p ON p.user_id = c.user_id AND p.at BETWEEN c.at - INTERVAL 24 HOUR AND c.at
  GROUP BY c.surface, c.request_id, c.at)""",
    f"""timed AS (
SELECT 'cli' AS surface, request_id, user_id, {nano_of('total_credits')} AS total_credits,
  CASE WHEN request_id % 7 <> 0 THEN event_timestamp END AS at FROM assistant_cli_usage)""",
)
def _(t):
    """Every seventh call has lost its time: it stays, without rolling spend."""
    calls = controls.surfaces(cli=t.assistant_cli_usage).withColumn(
        "event_timestamp", F.when(F.col("request_id") % 7 != 0, F.col("event_timestamp"))
    )
    capped = controls.rolling_cap(calls, LIMIT)
    return capped.select(
        "surface", "request_id", F.col("rolling_credits").cast("double").alias("rolling_credits"), "over_limit"
    )


def _calls(condition):
    return f"""
SELECT query_id, user_id, function_name, model_name, CAST(credits AS DOUBLE) AS credits, start_time
FROM ai_function_usage WHERE {condition}"""


def _plain(calls):
    return calls.withColumn("credits", F.col("credits").cast("double")).drop("role_names")


@query(
    "model_allowlist",
    _calls("model_name IS NOT NULL AND model_name NOT IN ('mistral-7b', 'llama3.1-70b')"),
)
def _(t):
    return _plain(controls.model_allowlist(t.ai_function_usage, "mistral-7b,llama3.1-70b"))


@query("model_allowlist_empty", _calls("model_name IS NOT NULL"))
def _(t):
    return _plain(controls.model_allowlist(t.ai_function_usage, []))


@query("model_allowlist_week", _calls(f"{last('start_time', 7)} AND model_name IS NOT NULL AND model_name <> 'mistral-7b'"))
def _(t):
    return _plain(controls.model_allowlist(t.ai_function_usage, "mistral-7b", AS_OF, 7))


@query("model_allowlist_none", _calls("true"))
def _(t):
    return _plain(controls.model_allowlist(t.ai_function_usage, "NONE"))


@query("model_allowlist_all", _calls("false"))
def _(t):
    return _plain(controls.model_allowlist(t.ai_function_usage, "ALL"))


@query(
    "run_budget",
    """
SELECT conv_id, turn AS first_step_over, CAST(tokens_used AS BIGINT) AS tokens_used, CAST(seconds_used AS BIGINT) AS seconds_used,
  CASE WHEN tokens_used > 600 AND seconds_used > 40 THEN 'tokens and seconds' WHEN tokens_used > 600 THEN 'tokens'
    ELSE 'seconds' END AS reason
FROM totals a WHERE (tokens_used > 600 OR seconds_used > 40) AND NOT EXISTS (
  SELECT 1 FROM totals b WHERE b.conv_id = a.conv_id AND b.turn < a.turn AND (b.tokens_used > 600 OR b.seconds_used > 40))""",
    """totals AS (
SELECT a.conv_id, a.turn, sum(CAST(ceil(length(b.text) / 4.0) AS BIGINT)) AS tokens_used,
  sum(CASE WHEN b.turn = 0 THEN 0 ELSE 7 END) AS seconds_used
FROM (SELECT DISTINCT conv_id, turn FROM conversations) a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn <= a.turn
GROUP BY 1, 2)""",
)
def _(t):
    steps = t.conversations.select(
        "conv_id",
        "turn",
        estimate_tokens(F.col("text")).alias("tokens"),
        F.when(F.col("turn") == 0, 0).otherwise(7).alias("seconds"),
    )
    return controls.run_budget(steps, max_tokens=600, max_seconds=40, block_steps=3)


@query(
    "role_grant_check",
    _calls(
        "role_names IS NULL OR NOT (list_contains(role_names, 'DATA_SCIENCE_ROLE') OR list_contains(role_names, 'ANALYST_ROLE'))"
    ),
)
def _(t):
    return _plain(
        controls.role_grant_check(t.ai_function_usage, ("DATA_SCIENCE_ROLE", "ANALYST_ROLE"))
    )


@query(
    "tag_format_check",
    f"""
SELECT query_id, query_tag, 'team,project,env' AS missing_keys FROM ai_sql_usage
WHERE {last('usage_time', 30)} AND (query_tag IS NULL OR query_tag NOT LIKE 'team=%')""",
)
def _(t):
    checked = controls.tag_format_check(t.ai_sql_usage, as_of=AS_OF, days=30)
    return checked.select("query_id", "query_tag", "missing_keys")


@query(
    "budget_history_latest",
    f"""
SELECT budget_name, CAST(spending_limit AS DOUBLE) AS spending_limit, CAST(credit_quota AS DOUBLE) AS credit_quota
FROM budget_history WHERE {last('start_time', 30)} ORDER BY start_time DESC, budget_name LIMIT 5""",
)
def _(t):
    return controls.budget_history_latest(t.budget_history, AS_OF)
