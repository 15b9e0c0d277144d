"""Queries and oracles of the anomaly reports."""

from checks.catalog import query
from checks.sql import AI_TYPES, credits, half_up, last, last_dates, nano
from spendlens.operators import anomaly
from spendlens.plans.rollup import hourly_rollup
from checks.fixtures import AS_OF


def _daily(days):
    return f"""daily AS (SELECT usage_date AS day, {nano('credits_billed')} AS c, row_number() OVER (ORDER BY usage_date) AS i
FROM metering_daily WHERE service_type IN {AI_TYPES} AND {last_dates('usage_date', days)} GROUP BY 1)"""


def _compared(join):
    pct = half_up("100 * (n.c - b.c)", "b.c", 1)
    return f"""
SELECT n.day, CAST(n.c AS DOUBLE) / 1e9 AS credits, CAST(b.c AS DOUBLE) / 1e9 AS last_week, {pct} AS wow_pct,
  CASE WHEN {pct} > 200 THEN 'red' WHEN {pct} > 50 THEN 'amber' ELSE 'normal' END AS level
FROM daily n LEFT JOIN daily b ON {join}"""


ROWS_BACK = _compared("b.i = n.i - 7")


@query("week_over_week", ROWS_BACK, _daily(60), traits=("daily window",))
def _(t):
    return anomaly.week_over_week(t.metering_daily, AS_OF)


@query("week_over_week_calendar", _compared("b.day = n.day - 7"), _daily(60))
def _(t):
    return anomaly.week_over_week_calendar(t.metering_daily, AS_OF)


@query(
    "wow_peak",
    f"""
SELECT max(wow_pct) AS peak_pct, coalesce(max(wow_pct) > 50, false) AS is_spike
FROM ({ROWS_BACK} ORDER BY n.day DESC LIMIT 30) newest""",
    _daily(60),
    traits=("daily window",),
)
def _(t):
    return anomaly.wow_peak(t.metering_daily, AS_OF)


@query(
    "daily_metering",
    f"""
SELECT usage_date AS day, service_type, {credits('credits_billed')} AS daily_credits,
  {credits('credits_used')} AS daily_credits_used
FROM metering_daily WHERE service_type IN {AI_TYPES} AND {last_dates('usage_date', 90)} GROUP BY 1, 2""",
)
def _(t):
    return anomaly.daily_metering(t.metering_daily, AS_OF)


@query(
    "daily_metering_like_ai",
    f"""
SELECT usage_date AS day, service_type, {credits('credits_billed')} AS daily_credits,
  {credits('credits_used')} AS daily_credits_used
FROM metering_daily WHERE lower(service_type) LIKE '%ai%' AND {last_dates('usage_date', 90)} GROUP BY 1, 2""",
)
def _(t):
    return anomaly.daily_metering(t.metering_daily, AS_OF, types="%AI%")


WEEKLY = f"""weekly AS (
SELECT u.name AS user_name, CAST(date_trunc('week', start_time) AS TIMESTAMP) AS week, {nano('credits')} AS c,
  row_number() OVER (PARTITION BY u.name ORDER BY date_trunc('week', start_time)) AS i
FROM ai_function_usage h LEFT JOIN users u ON h.user_id = u.user_id WHERE {last('start_time', 60)}
GROUP BY u.name, date_trunc('week', start_time)),
spikes AS (
SELECT n.user_name, n.week, max(n.c) AS c, sum(b.c) AS s, count(b.c) AS k
FROM weekly n LEFT JOIN weekly b ON b.user_name IS NOT DISTINCT FROM n.user_name AND b.i BETWEEN n.i - 4 AND n.i - 1
GROUP BY 1, 2)"""

SPIKES = f"""
SELECT user_name, week, CAST(c AS DOUBLE) / 1e9 AS weekly_credits,
  (CAST(s AS DOUBLE) / 1e9) / k AS avg_prev_4_weeks, {half_up('c * k', 's', 1)} AS multiplier
FROM spikes WHERE k > 0 AND {half_up('c * k', 's', 1)} > 3"""


@query("user_weekly_spike", SPIKES, WEEKLY)
def _(t):
    return anomaly.user_weekly_spike(t.ai_function_usage, t.users, AS_OF)


@query("user_weekly_spike_from_rollup", SPIKES, WEEKLY)
def _(t):
    rollup = hourly_rollup(t.ai_function_usage, "start_time", "credits")
    return anomaly.user_weekly_spike(rollup, t.users, AS_OF)


@query(
    "rolling_spike",
    """
SELECT n.day, CAST(max(n.c) AS DOUBLE) / 1e9 AS credits, (CAST(sum(b.c) AS DOUBLE) / 1e9) / count(*) AS rolling_7d_avg,
  (CAST(max(n.c) AS DOUBLE) / 1e9) / ((CAST(sum(b.c) AS DOUBLE) / 1e9) / count(*)) AS spike_ratio,
  (CAST(max(n.c) AS DOUBLE) / 1e9) / ((CAST(sum(b.c) AS DOUBLE) / 1e9) / count(*)) > 3.0 AS is_anomaly
FROM daily n JOIN daily b ON b.i BETWEEN n.i - 6 AND n.i GROUP BY n.day""",
    _daily(30),
    traits=("daily window",),
)
def _(t):
    return anomaly.rolling_spike(t.metering_daily, AS_OF)
