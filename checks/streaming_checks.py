"""Streaming queries, run over all data there is, against batch oracles."""

from checks.catalog import query, run_folder
from checks.control_checks import ACCOUNT_LIMIT, limits_table
from checks.sql import credits, dollars, half_up, nano_of, rounded
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from checks.fixtures import USAGE_TIME, VIEWS, source
from spendlens.streaming import events, rollup, sinks, spend


BATCHES = 3
_feeds: dict[tuple[str, str, str], tuple[str, int]] = {}


def time_parts(rows: DataFrame, at: Column, parts: int) -> list[DataFrame]:
    """Rows cut by event time into equal parts; those without a time are in the last."""
    micros = F.unix_micros(at.cast("timestamp"))
    cuts = rows.select(micros.alias("at")).approxQuantile("at", [i / parts for i in range(1, parts)], 0.01)
    bounds = [None, *map(int, cuts), None] if cuts else [None, None]
    found = []
    for low, high in zip(bounds, bounds[1:]):
        after = F.lit(True) if low is None else F.coalesce(micros > low, F.lit(True))
        before = F.lit(True) if high is None else F.coalesce(micros <= high, F.lit(False))
        found.append(rows.where(after & before))
    return found


def _feed(t, base, at):
    """The source table as folders in order of time, the way a log arrives; once per session.

    A folder has as many files as Spark's partitions make of it.
    """
    key = (t.spark.sparkContext.applicationId, t.sf_dir, base)
    if key not in _feeds:
        folder = run_folder(t.spark, f"feed-{base}")
        parts = time_parts(source(t.spark, t.sf_dir, base), F.expr(at), BATCHES)
        for n, part in enumerate(parts):
            part.write.parquet(f"{folder}/part-{n}")
        _feeds[key] = folder, len(parts)
    return _feeds[key]


def _runs(t, view, at):
    """A derived usage table as a stream, once for each folder that has arrived by then.

    To drain one after the other on the same checkpoint: each is a batch after a restart.
    """
    base, sql = VIEWS[view]
    schema = source(t.spark, t.sf_dir, base).schema
    folder, parts = _feed(t, base, at)
    for n in range(parts):
        arrived = ",".join(f"part-{i}" for i in range(n + 1))
        stream = spend.read_calls(t.spark, f"{folder}/{{{arrived}}}", schema)
        yield t.spark.sql(sql.replace(f"FROM {base}", "FROM {base}"), base=stream)


def _ntz(df, *columns):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@query(
    "stream_hourly_spend",
    f"""
SELECT date_trunc('hour', start_time) AS hour_bucket, function_name, count(*) AS ai_calls,
  {rounded('credits', 4)} AS ai_credits, {dollars('credits')} AS est_dollars
FROM ai_function_usage GROUP BY 1, 2""",
)
def _(t):
    folder = run_folder(t.spark, "hourly-spend")
    for calls in _runs(t, "ai_function_usage", "ts"):
        drained = sinks.drain_updates(spend.stream_hourly_spend(calls), ["hour_bucket", "function_name"], folder)
    return _ntz(drained, "hour_bucket")


@query(
    "stream_budget_burn",
    f"""
SELECT 'account' AS scope, month, 900.0::DOUBLE AS budget, CAST(c AS DOUBLE) / 1e9 AS spend,
  {half_up('100 * c', '900000000000', 1)} AS pct_used,
  CAST(CASE WHEN c >= 810000000000 THEN 90 WHEN c >= 720000000000 THEN 80 WHEN c >= 675000000000 THEN 75
    WHEN c >= 450000000000 THEN 50 ELSE 0 END AS DOUBLE) AS reached_pct
FROM (SELECT CAST(date_trunc('month', usage_time) AS TIMESTAMP) AS month, sum({nano_of('token_credits')}) AS c
      FROM ai_sql_usage GROUP BY 1) monthly""",
)
def _(t):
    limits, folder = limits_table(t, ACCOUNT_LIMIT), run_folder(t.spark, "budget-burn")
    for calls in _runs(t, "ai_sql_usage", USAGE_TIME):
        burn = spend.stream_budget_burn(calls, limits, F.lit("account"))
        drained = sinks.drain_updates(burn, ["scope", "month"], folder)
    return _ntz(drained, "month")


# A window is released once the watermark, 45 minutes behind the newest call,
# has passed its end.
RELEASED = "(SELECT max(event_timestamp) - INTERVAL 45 MINUTE FROM assistant_cli_usage)"


@query(
    "stream_sliding_spend",
    f"""
SELECT user_id, window_start, window_start + INTERVAL 24 HOUR AS window_end, count(*) AS calls,
  CAST(sum({nano_of('total_credits')}) AS DOUBLE) / 1e9 AS credits
FROM (SELECT *, unnest(generate_series(date_trunc('hour', event_timestamp) - INTERVAL 23 HOUR,
        date_trunc('hour', event_timestamp), INTERVAL 1 HOUR)) AS window_start FROM assistant_cli_usage) spread
WHERE window_start + INTERVAL 24 HOUR <= {RELEASED} GROUP BY 1, 2""",
)
def _(t):
    folder = run_folder(t.spark, "sliding-spend")
    for calls in _runs(t, "assistant_cli_usage", "ts"):
        drained = sinks.drain_rows(spend.stream_sliding_spend(calls), folder)
    return _ntz(drained, "window_start", "window_end")


@query(
    "stream_rolling_cap",
    f"""
SELECT n.user_id, n.minute, max(n.calls) AS calls, CAST(sum(p.c) AS DOUBLE) / 1e9 AS rolling_credits,
  sum(p.c) > 6000000 AS over_limit
FROM minutes n JOIN minutes p ON p.user_id = n.user_id AND p.minute > n.minute - INTERVAL 24 HOUR AND p.minute <= n.minute
GROUP BY 1, 2""",
    f"""minutes AS (
SELECT user_id, date_trunc('minute', event_timestamp) AS minute, count(*) AS calls, sum({nano_of('total_credits')}) AS c
FROM assistant_cli_usage WHERE date_trunc('minute', event_timestamp) + INTERVAL 1 MINUTE <= {RELEASED} GROUP BY 1, 2)""",
)
def _(t):
    folder = run_folder(t.spark, "rolling-cap")
    with spend.rocksdb_state(t.spark):
        for calls in _runs(t, "assistant_cli_usage", "ts"):
            drained = sinks.drain_rows(spend.stream_rolling_cap(calls, 0.006), folder)
    return _ntz(drained, "minute")


@query(
    "stream_rollup",
    f"""
SELECT date_trunc('hour', start_time) AS hour, user_id, function_name, model_name, count(*) AS calls,
  {credits('credits')} AS credits_sum, min(start_time) AS first_time, max(start_time) AS last_time
FROM ai_function_usage GROUP BY 1, 2, 3, 4""",
)
def _(t):
    """Rows of the stored rollup after all batches."""
    folder = run_folder(t.spark, "stream-rollup")
    for calls in _runs(t, "ai_function_usage", "ts"):
        rollup.write_rollup(calls, f"{folder}/rows", f"{folder}/checkpoint", "start_time", "credits", True).awaitTermination()
    rows = rollup.read_rollup(t.spark, f"{folder}/rows")
    return rows.select(
        "hour", "user_id", "function_name", "model_name", "calls",
        F.col("credits_sum").cast("double").alias("credits_sum"), "first_time", "last_time",
    )


# The SQL log released in order of time.
LOG_RELEASED = "(SELECT max(usage_time) - INTERVAL 45 MINUTE FROM ai_sql_usage)"


@query(
    "stream_budget_events",
    """
SELECT 'account' AS scope, month, 'crossed' AS event, CAST(pct AS DOUBLE) AS threshold_pct,
  min(usage_time) AS at, CAST(arg_min(used, usage_time) AS DOUBLE) / 1e9 AS spend, 900.0::DOUBLE AS budget
FROM running, (VALUES (50), (75), (80), (90)) AS steps(pct) WHERE used >= 900 * pct * 10000000::HUGEINT GROUP BY month, pct
UNION ALL
SELECT 'account', month, 'closed', NULL, month + INTERVAL 1 MONTH, CAST(max(total) AS DOUBLE) / 1e9, 900.0
FROM running WHERE month + INTERVAL 1 MONTH <= """ + LOG_RELEASED + " GROUP BY month",
    f"""running AS (
SELECT *, sum(c) OVER (PARTITION BY month ORDER BY usage_time) AS used, sum(c) OVER (PARTITION BY month) AS total
FROM (SELECT CAST(date_trunc('month', usage_time) AS TIMESTAMP) AS month, usage_time, sum({nano_of('token_credits')}) AS c
      FROM ai_sql_usage WHERE usage_time <= {LOG_RELEASED} GROUP BY 1, 2))""",
)
def _(t):
    limits, folder = limits_table(t, ACCOUNT_LIMIT), run_folder(t.spark, "budget-events")
    with spend.rocksdb_state(t.spark):
        for calls in _runs(t, "ai_sql_usage", USAGE_TIME):
            drained = sinks.drain_rows(events.stream_budget_events(calls, limits, F.lit("account")), folder)
    return _ntz(drained, "month", "at")


# Runs are a user's calls with no pause of more than two hours.
RUN_SQL = f"""steps AS (
SELECT user_id, event_timestamp AS moment, sum(total_tokens) AS tokens FROM assistant_cli_usage
WHERE event_timestamp <= {RELEASED} GROUP BY 1, 2),
begun AS (
SELECT *, coalesce(moment - lag(moment) OVER w > INTERVAL 2 HOUR, true) AS begins FROM steps WINDOW w AS (PARTITION BY user_id ORDER BY moment)),
numbered AS (
SELECT *, sum(begins::INT) OVER (PARTITION BY user_id ORDER BY moment) AS run FROM begun),
used AS (
SELECT *, sum(tokens) OVER w AS tokens_used, epoch_us(moment) - epoch_us(min(moment) OVER w) AS elapsed FROM numbered
WINDOW w AS (PARTITION BY user_id, run ORDER BY moment))"""


@query(
    "stream_run_budget",
    f"""
SELECT user_id, 'tokens' AS event, min(moment) AS at, CAST(min(tokens_used) AS BIGINT) AS tokens_used,
  min(elapsed) / 1e6 AS seconds_used FROM used WHERE tokens_used > 1500 GROUP BY user_id, run
UNION ALL
SELECT user_id, 'seconds', min(moment), CAST(min(tokens_used) AS BIGINT), min(elapsed) / 1e6
FROM used WHERE elapsed > 7200000000 GROUP BY user_id, run
UNION ALL
SELECT user_id, 'silent', max(moment) + INTERVAL 2 HOUR, CAST(max(tokens_used) AS BIGINT), max(elapsed) / 1e6
FROM used GROUP BY user_id, run HAVING max(moment) + INTERVAL 2 HOUR < {RELEASED}""",
    RUN_SQL,
)
def _(t):
    folder = run_folder(t.spark, "run-budget")
    with spend.rocksdb_state(t.spark):
        for steps in _runs(t, "assistant_cli_usage", "ts"):
            found = events.stream_run_budget(steps, "user_id", tokens="total_tokens", max_tokens=1500, max_seconds=7200)
            drained = sinks.drain_rows(found, folder)
    return _ntz(drained, "at")


# Each third user got another limit when the log began, and the user's calls of mid-month
# on are held against a second one.
LIMITED = f"""minutes AS (
SELECT user_id, date_trunc('minute', event_timestamp) AS minute, count(*) AS calls, sum({nano_of('total_credits')}) AS c
FROM assistant_cli_usage WHERE date_trunc('minute', event_timestamp) + INTERVAL 1 MINUTE <= {RELEASED} GROUP BY 1, 2)"""
_LIMIT = """CASE WHEN n.user_id % 3 <> 0 THEN 6000000 WHEN n.minute >= TIMESTAMP '2024-01-15 12:30:00' THEN 1000000
  ELSE 4000000 END"""


@query(
    "stream_rolling_cap_limits",
    f"""
SELECT n.user_id, n.minute, max(n.calls) AS calls, CAST(sum(p.c) AS DOUBLE) / 1e9 AS rolling_credits,
  CAST({_LIMIT} AS DOUBLE) / 1e9 AS credit_limit, sum(p.c) > {_LIMIT} AS over_limit
FROM minutes n JOIN minutes p ON p.user_id = n.user_id AND p.minute > n.minute - INTERVAL 24 HOUR AND p.minute <= n.minute
GROUP BY n.user_id, n.minute""",
    LIMITED,
)
def _(t):
    folder = run_folder(t.spark, "rolling-cap-limits")
    users = t.assistant_cli_usage.where("user_id % 3 = 0").groupBy("user_id").agg(F.min("event_timestamp").alias("first"))
    start = users.agg(F.min("first")).first()[0]

    def change(credits, since):
        return F.struct(
            F.lit(credits).cast("decimal(18,9)").alias("credits"),
            F.lit(since).cast("timestamp_ntz").alias("valid_from"),
            F.lit(start).cast("timestamp_ntz").alias("changed_at"),
        )

    both = F.array(change("0.004", str(start)[:17] + "00"), change("0.001", "2024-01-15 12:30:00"))
    rows = users.where("user_id % 3 = 0").select("user_id", F.explode(both).alias("c")).select("user_id", "c.*")
    rows.write.parquet(f"{folder}/changes")
    with spend.rocksdb_state(t.spark):
        for calls in _runs(t, "assistant_cli_usage", "ts"):
            changes = spend.read_calls(t.spark, f"{folder}/changes", rows.schema)
            drained = sinks.drain_rows(events.stream_rolling_cap_limits(calls, changes, 0.006), folder)
    return _ntz(drained, "minute")
