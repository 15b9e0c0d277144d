"""Exact distinct users of any hours, from bitmaps instead of user rows.

A set of user ids is a bitmap per block of 32,768 ids. Bitmaps are united by OR, so
the users of a month are counted from its hours; a plain count per hour could not be
added up. An hour takes 4 KB for each block of ids that it saw.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlens.functions.time import EVENT_DATE, parse_as_of, recent, truncated


def user_bitmaps(log: DataFrame, time_col: str, user_col: str = "user_id", by: tuple[str, ...] = ("function_name",)) -> DataFrame:
    """One row per hour, group and block of ids: ``hour``, the group, ``id_block``, ``users``.

    Rows without a user are in no set; rows without a time are in the hour NULL.
    """
    user = F.col(user_col)
    hour = truncated(log, "hour", time_col)
    return (
        log.where(user.isNotNull())
        .groupBy(hour.alias("hour"), *by, F.bitmap_bucket_number(user).alias("id_block"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(user)).alias("users"))
        .withColumn(EVENT_DATE, F.to_date("hour"))
    )


def distinct_users(bitmaps: DataFrame, *by: str | Column) -> DataFrame:
    """Distinct users per group, over all hours given; without a group one row."""
    united = bitmaps.groupBy(*by, "id_block").agg(F.bitmap_count(F.bitmap_or_agg("users")).alias("n"))
    return united.groupBy(*by).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("unique_users"))


def bitmaps_within(bitmaps: DataFrame, as_of, *, days: float | None = None, hours: float | None = None) -> DataFrame:
    """The bitmaps of a window of whole hours; the hour that starts at ``as_of`` lies after it."""
    moment = parse_as_of(as_of)
    if (moment.minute, moment.second, moment.microsecond) != (0, 0, 0):
        raise ValueError("bitmaps answer only for windows that begin and end on the hour")
    inside = recent(bitmaps, "hour", moment, days=days, hours=hours)
    return inside.where(F.col("hour") < F.lit(str(moment)).cast(bitmaps.schema["hour"].dataType))
