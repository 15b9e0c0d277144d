"""Running totals that split one key's history over many tasks.

A window ``PARTITION BY user ORDER BY time`` puts a user's whole history into
one task, and one user may own a third of the log. Here each key is cut into
blocks along the order column: block sums come from an ordinary aggregation, a
window over the few block rows turns them into the total carried into each
block, and the row-level window then runs per key and block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    values: Sequence[str],
    block: Column,
    prefix: str = "running_",
) -> DataFrame:
    """Add ``running_<value>``: the total of each value up to and with this row.

    Rows with equal ``order`` count together, as in a RANGE frame. ``block``
    must not decrease as ``order`` grows.
    """
    rows = df.withColumn("_block", block)
    sums = rows.groupBy(*keys, "_block").agg(*[F.sum(v).alias(v) for v in values])
    earlier = (
        Window.partitionBy(*keys)
        .orderBy("_block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # The carried total joins its block as one more row that sorts first, so the
    # same shuffle serves both and NULL keys need no special care.
    carried = sums.select(
        *keys,
        "_block",
        F.lit(0).alias("_row"),
        *[F.sum(v).over(earlier).alias(v) for v in values],
    )
    within = (
        Window.partitionBy(*keys, "_block")
        .orderBy("_row", order)
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        rows.withColumn("_row", F.lit(1))
        .unionByName(carried, allowMissingColumns=True)
        .select("*", *[F.sum(v).over(within).alias(prefix + v) for v in values])
        .where("_row = 1")
        .drop("_row", "_block")
    )


def instant_totals(
    df: DataFrame,
    keys: Sequence[str],
    time_col: str,
    value: str,
    hours: int = 24,
    block: str = "1 minute",
) -> DataFrame:
    """Per key and instant (``_at``) its sum ``_change``, and ``_rolling`` over the ``hours`` up to it.

    An instant adds its sum when it happens and takes it back one microsecond after
    the window has passed it; the rolling total is then the running total of those
    moves, which splits into blocks. Rows without a time are left out.
    """
    instants = (
        df.where(F.col(time_col).isNotNull())
        .groupBy(*keys, F.col(time_col).alias("_at"))
        .agg(F.sum(value).alias("_change"))
    )
    gone = F.col("_at") + F.expr(f"INTERVAL '{int(hours) * 3600}.000001' SECOND")
    change = F.col("_change").cast("decimal(28,9)")
    added = F.struct(F.col("_at"), change.alias("_change"), F.lit(True).alias("_real"))
    removed = F.struct(gone.alias("_at"), (-change).alias("_change"), F.lit(False).alias("_real"))
    moves = instants.select(*keys, F.explode(F.array(added, removed)).alias("_move")).select(
        *keys, "_move._at", "_move._change", "_move._real"
    )
    block_start = F.window("_at", block).start
    totals = running_totals(moves, keys, "_at", ["_change"], block_start, prefix="_total")
    return totals.where("_real").select(
        *keys, "_at", "_change", F.col("_total_change").cast("decimal(28,9)").alias("_rolling")
    )


def rolling_totals(
    df: DataFrame,
    keys: Sequence[str],
    time_col: str,
    value: str,
    hours: int = 24,
    block: str = "1 minute",
) -> DataFrame:
    """Add ``rolling_<value>``: the total over the ``hours`` up to each row.

    Both ends count, as in ``RANGE BETWEEN n HOURS PRECEDING AND CURRENT ROW``. A row
    without a time is in no window and gets NULL. Only keys, instants and sums take
    part in the work on windows; the rows meet the result once.
    """
    totals = instant_totals(df, keys, time_col, value, hours, block).withColumnRenamed(
        "_rolling", f"rolling_{value}"
    )
    return meet_instants(df, keys, time_col, totals.drop("_change"))


def meet_instants(df: DataFrame, keys: Sequence[str], time_col: str, instants: DataFrame) -> DataFrame:
    """``df`` with the other columns of ``instants``, one row per key and ``_at``; NULL where none.

    Rows without a time find nothing; a hash keeps them from meeting in one task.
    """
    extra = [c for c in instants.columns if c not in (*keys, "_at")]
    other = instants.select(
        *[F.col(k).alias(f"_{k}") for k in keys],
        F.col("_at"),
        F.lit(0).cast("bigint").alias("_apart"),
        *extra,
    )
    apart = F.when(F.col(time_col).isNull(), F.xxhash64(*df.columns)).otherwise(0)
    same = (F.col(time_col) == F.col("_at")) & (F.col("_spread") == F.col("_apart"))
    for key in keys:
        same &= F.col(key).eqNullSafe(F.col(f"_{key}"))
    return df.withColumn("_spread", apart).join(other, same, "left").select(*df.columns, *extra)
