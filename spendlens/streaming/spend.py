"""Streaming spend: hourly totals, budget burn and the rolling 24-hour cap.

Usage logs arrive about 45 minutes late, so that is the default watermark. All
grouping is done by built-in aggregation, which combines on the map side: a
user with a large share of the calls sends one row per task and window into
the shuffle. The rolling cap needs a custom operator, but only on those
per-minute sums, and one call of it serves a shard of keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.functions.money import (
    PRICE_PER_CREDIT,
    credit,
    dec,
    dollars,
    quotient,
    ratio,
    rounded,
)
from spendlens.operators.controls import BUDGET_THRESHOLDS, CAP_HOURS, DAILY_LIMIT
from spendlens.streaming.shards import Due, Lapse, Walk, walk_keys

#: Delay of the source logs.
LOG_DELAY = "45 minutes"

#: Nano-credits: DECIMAL(18,9) credits as an exact integer.
_NANO = 1_000_000_000

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_calls(
    spark: SparkSession, folder: str, schema, files: str = "*", files_per_batch: int | None = None
) -> DataFrame:
    """Stream of new parquet files in a folder whose names match ``files``."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", files)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def timed(calls: DataFrame, time_col: str, delay: str = LOG_DELAY) -> DataFrame:
    """Event time as TIMESTAMP (watermarks reject TIMESTAMP_NTZ), with a watermark."""
    return calls.withColumn("_at", F.col(time_col).cast("timestamp")).withWatermark("_at", delay)


def stream_hourly_spend(
    calls, time_col="start_time", credit_col="credits", delay=LOG_DELAY, price=PRICE_PER_CREDIT
) -> DataFrame:
    """Calls, credits and dollars per hour and function; rows later than ``delay`` drop."""
    return (
        timed(calls, time_col, delay)
        .groupBy(F.window("_at", "1 hour").alias("w"), "function_name")
        .agg(F.count(F.lit(1)).alias("ai_calls"), F.sum(credit(credit_col)).alias("c"))
        .select(
            F.col("w.start").alias("hour_bucket"),
            "function_name",
            "ai_calls",
            rounded(F.col("c"), 4).alias("ai_credits"),
            dollars(F.col("c"), price).alias("est_dollars"),
        )
    )


def stream_budget_burn(
    calls,
    limits,
    scope: Column,
    time_col="usage_time",
    credit_col="token_credits",
    thresholds: Sequence[float] = BUDGET_THRESHOLDS,
) -> DataFrame:
    """Month-to-date spend per budget scope, and the highest threshold reached.

    For update mode. A budget counts every billed call, so a late one is added
    to its month however late it is; the state is one sum per scope and month.
    """
    month = F.date_trunc("month", F.col(time_col).cast("timestamp"))
    spent = calls.groupBy(scope.alias("scope"), month.alias("month")).agg(
        F.sum(credit(credit_col)).alias("c")
    )
    used = ratio(F.col("c") * dec(100), F.col("budget"))
    reached = F.lit(0.0)
    for step in sorted(thresholds):
        reached = F.when(used >= dec(step), F.lit(float(step))).otherwise(reached)
    budgets = limits.select("scope", credit("credits").alias("budget"))
    return spent.join(budgets, "scope").select(
        "scope",
        "month",
        F.col("budget").cast("double").alias("budget"),
        F.col("c").cast("double").alias("spend"),
        quotient(F.col("c"), F.col("budget"), 1, times=100).cast("double").alias("pct_used"),
        reached.alias("reached_pct"),
    )


def stream_sliding_spend(
    calls,
    keys: Sequence[str] = ("user_id",),
    time_col="event_timestamp",
    credit_col="total_credits",
    hours=CAP_HOURS,
    slide="1 hour",
    delay=LOG_DELAY,
) -> DataFrame:
    """Coarse rolling spend: 24-hour windows that start every hour."""
    return (
        timed(calls, time_col, delay)
        .groupBy(F.window("_at", f"{hours} hours", slide).alias("w"), *keys)
        .agg(F.sum(credit(credit_col)).alias("c"), F.count(F.lit(1)).alias("calls"))
        .select(
            *keys,
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "calls",
            F.col("c").cast("double").alias("credits"),
        )
    )


def _rolling_minutes(hours: int) -> tuple[Walk, Due, Lapse]:
    """Turns per-minute sums of one key into rolling sums.

    State is one (minute, sum) pair per minute of the last ``hours``: its size
    follows the clock, not the number of calls.
    """
    span = hours * 3_600_000_000

    def walk(state, rows):
        held = [*zip(*state)] if state else []
        total, first, out = sum(n or 0 for _, n in held), 0, []
        known = sum(n is not None for _, n in held)
        for minute, nano, calls in rows:
            held.append((minute, nano))
            total += nano or 0
            known += nano is not None
            while held[first][0] <= minute - span:
                total -= held[first][1] or 0
                known -= held[first][1] is not None
                first += 1
            out.append((minute, calls, total if known else None))
        return ([m for m, _ in held[first:]], [n for _, n in held[first:]]), out

    def due(state):
        return (state[0][-1] + span) // 1000

    def lapse(state):
        return None, []

    return walk, due, lapse


@contextmanager
def rocksdb_state(spark: SparkSession):
    """RocksDB as state store, which the custom operator needs, while a query starts."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def stream_rolling_cap(
    calls,
    limit=DAILY_LIMIT,
    keys: Sequence[str] = ("user_id",),
    time_col="event_timestamp",
    credit_col="total_credits",
    hours=CAP_HOURS,
    delay=LOG_DELAY,
) -> DataFrame:
    """Rolling spend per user at every minute with calls, flagged when over the limit.

    For append mode, started inside ``rocksdb_state``. Calls are first summed
    per minute, which also puts late calls in their place: a minute is released
    once the watermark has passed it, so the result does not depend on how the
    calls were cut into batches.
    """
    minutes = (
        timed(calls, time_col, delay)
        .groupBy(F.window("_at", "1 minute").alias("w"), *keys)
        .agg(F.sum(credit(credit_col)).alias("c"), F.count(F.lit(1)).alias("calls"))
        .select(
            *keys,
            F.window_time("w").alias("released"),
            F.unix_micros("w.start").alias("minute"),
            (F.col("c") * dec(_NANO)).cast("bigint").alias("nano"),
            "calls",
        )
    )
    rolled = walk_keys(
        minutes, keys, "released", ["minute", "nano", "calls"], "minutes array<bigint>, nanos array<bigint>",
        "minute bigint, calls bigint, rolling_nano bigint", *_rolling_minutes(hours),
    )
    rolling = F.col("rolling_nano").cast("decimal(28,0)") * dec("0.000000001")
    return rolled.select(
        *keys,
        F.timestamp_micros("minute").alias("minute"),
        "calls",
        rolling.cast("double").alias("rolling_credits"),
        (rolling > dec(limit)).alias("over_limit"),
    )
