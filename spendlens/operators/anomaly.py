"""Spikes: week over week, rolling mean, and per user against earlier weeks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendlens.functions.money import dec, quotient, resummed, total
from spendlens.functions.time import recent
from spendlens.operators.attribution import AI_SERVICE_TYPES, of_types
from spendlens.plans.rollup import FUNCTION_LOG, Usage


def _daily(metering: DataFrame, as_of, days: int, types) -> DataFrame:
    """Billed credits per day: at most ``days`` + 1 rows."""
    return (
        recent(metering, "usage_date", as_of, days=days, whole_days=True)
        .where(of_types(types))
        .groupBy(F.to_date("usage_date").alias("day"))
        .agg(total("credits_billed").alias("c"))
    )


def _change(now: Column, before: Column) -> Column:
    """Change in percent, one decimal; NULL when there is nothing to compare."""
    return quotient(now - before, before, 1, times=100)


def _compared(daily: DataFrame, amber: float, red: float) -> DataFrame:
    pct = _change(F.col("c"), F.col("before"))
    level = F.when(pct > red, "red").when(pct > amber, "amber").otherwise("normal")
    return daily.select(
        "day",
        F.col("c").cast("double").alias("credits"),
        F.col("before").cast("double").alias("last_week"),
        pct.cast("double").alias("wow_pct"),
        level.alias("level"),
    ).orderBy(F.desc_nulls_first("day"))


def week_over_week(
    metering, as_of, days=60, types=AI_SERVICE_TYPES, amber=50, red=200
) -> DataFrame:
    """Daily credits against the value seven rows earlier.

    Rows, not days: a missing day shifts the comparison. The calendar form
    below does not shift. The window runs over the daily totals only.
    """
    daily = _daily(metering, as_of, days, types)
    return _compared(
        daily.withColumn("before", F.lag("c", 7).over(Window.orderBy("day"))), amber, red
    )


def week_over_week_calendar(
    metering, as_of, days=60, types=AI_SERVICE_TYPES, amber=50, red=200
) -> DataFrame:
    """Daily credits against the same weekday one week earlier.

    Each day's total is offered to its own day and to the day a week later, so
    the pairs meet in one aggregation instead of a self-join.
    """
    daily = _daily(metering, as_of, days, types)
    offered = daily.select(
        F.explode(
            F.array(
                F.struct(F.col("day"), F.col("c"), F.lit(None).cast("decimal(28,9)").alias("b")),
                F.struct(
                    F.date_add("day", 7).alias("day"),
                    F.lit(None).cast("decimal(28,9)").alias("c"),
                    F.col("c").alias("b"),
                ),
            )
        ).alias("o")
    )
    paired = offered.groupBy(F.col("o.day").alias("day")).agg(
        F.max("o.c").alias("c"), F.max("o.b").alias("before")
    )
    return _compared(paired.where(F.col("c").isNotNull()), amber, red)


def wow_peak(
    metering, as_of, days=60, latest=30, types=AI_SERVICE_TYPES, amber=50, red=200
) -> DataFrame:
    """Highest week-over-week change among the latest days, as one row."""
    newest = week_over_week(metering, as_of, days, types, amber, red).limit(latest)
    return newest.agg(F.max("wow_pct").alias("peak_pct")).select(
        "peak_pct", F.coalesce(F.col("peak_pct") > amber, F.lit(False)).alias("is_spike")
    )


def daily_metering(metering, as_of, days=90, types=AI_SERVICE_TYPES) -> DataFrame:
    """Billed and used credits per day and type."""
    return (
        recent(metering, "usage_date", as_of, days=days, whole_days=True)
        .where(of_types(types))
        .groupBy(F.to_date("usage_date").alias("day"), "service_type")
        .agg(
            total("credits_billed").cast("double").alias("daily_credits"),
            total("credits_used").cast("double").alias("daily_credits_used"),
        )
        .orderBy(
            F.desc_nulls_first("day"), F.desc_nulls_first("daily_credits"), "service_type"
        )
    )


def user_weekly_spike(calls, users, as_of, days=60, over=3) -> DataFrame:
    """User weeks whose spend exceeds ``over`` times the mean of the four weeks before.

    The test is on the multiplier rounded to one decimal. The window sees one
    row per user and week.
    """
    log = Usage.of(calls, FUNCTION_LOG).window(as_of, days=days)
    weekly = (
        log.df.groupBy("user_id", log.bucket("week").alias("week"))
        .agg(log.credits().alias("c"))
        .join(users.select("user_id", F.col("name").alias("user_name")), "user_id", "left")
        .groupBy("user_name", "week")
        .agg(resummed("c").alias("c"))
    )
    before = Window.partitionBy("user_name").orderBy("week").rowsBetween(-4, -1)
    return (
        weekly.select(
            "user_name",
            "week",
            "c",
            F.sum("c").over(before).alias("s"),
            F.count("c").over(before).alias("k"),
        )
        .withColumn("m", quotient(F.col("c") * F.col("k").cast("decimal(1,0)"), F.col("s"), 1))
        .where(F.col("m") > dec(over))
        .select(
            "user_name",
            "week",
            F.col("c").cast("double").alias("weekly_credits"),
            F.try_divide(F.col("s").cast("double"), F.col("k").cast("double")).alias(
                "avg_prev_4_weeks"
            ),
            F.col("m").cast("double").alias("multiplier"),
        )
        .orderBy(F.desc_nulls_first("week"), F.desc_nulls_first("weekly_credits"), "user_name")
    )


def rolling_spike(metering, as_of, days=30, types=AI_SERVICE_TYPES, over=3.0) -> DataFrame:
    """Daily credits against the mean of the latest seven daily rows."""
    latest = Window.orderBy("day").rowsBetween(-6, 0)
    rolling = F.try_divide(F.col("s").cast("double"), F.col("k").cast("double"))
    spike = F.try_divide(F.col("c").cast("double"), rolling)
    return (
        _daily(metering, as_of, days, types)
        .select(
            "day", "c", F.sum("c").over(latest).alias("s"), F.count("c").over(latest).alias("k")
        )
        .select(
            "day",
            F.col("c").cast("double").alias("credits"),
            rolling.alias("rolling_7d_avg"),
            spike.alias("spike_ratio"),
            F.coalesce(spike > over, F.lit(False)).alias("is_anomaly"),
        )
        .orderBy(F.desc_nulls_first("day"))
    )

