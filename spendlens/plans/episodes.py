"""Decisions that depend on earlier decisions, folded only where they can differ.

A cap that is enforced does not count what it blocked, so each decision depends on
those before. But as long as all spend of a window stays under the cap, nothing in
it was blocked, and the state is known from the calls alone. Histories are cut
there: an episode is a run of instants over the cap with no gap longer than the
window, and only episodes, with the window before them, are folded in order.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _hours(start, end):
    hour = F.expr("INTERVAL 1 HOUR")
    return F.explode(F.sequence(F.date_trunc("hour", start), F.date_trunc("hour", end), hour))


def episodes(over: DataFrame, keys: Sequence[str], hours: int) -> DataFrame:
    """Per key the ``_start`` and ``_end`` of each run of ``_at`` without a gap over ``hours``.

    A gap that long cannot lie within an hour, so one row per key and hour is put in
    order, which follows the clock and not the number of calls.
    """
    by_key = Window.partitionBy(*keys).orderBy("_hour")
    before = F.max("_last").over(by_key.rowsBetween(Window.unboundedPreceding, -1))
    apart = before.isNull() | (F.col("_first") > before + F.expr(f"INTERVAL {int(hours)} HOUR"))
    return (
        over.groupBy(*keys, F.date_trunc("hour", "_at").alias("_hour"))
        .agg(F.min("_at").alias("_first"), F.max("_at").alias("_last"))
        .withColumn("_begins", apart.cast("int"))
        .withColumn("_nth", F.sum("_begins").over(by_key.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, "_nth")
        .agg(F.min("_first").alias("_start"), F.max("_last").alias("_end"))
        .drop("_nth")
    )


def _fold(n_keys: int, hours: int):
    """Blocked instants of sorted (start, keys, at, nano, cap) rows, one episode after the other.

    Holds the instants of one window that counted, however long the episode is.
    """
    span = int(hours) * 3_600_000_000

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present, held, spent = None, deque(), 0
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(n_keys + 1)]
            micros, nano, cap = (batch.column(f"_{c}").to_pylist() for c in ("micros", "nano", "cap"))
            blocked = []
            for i, episode in enumerate(zip(*columns)):
                if episode != present:
                    present, held, spent = episode, deque(), 0
                while held and held[0][0] < micros[i] - span:
                    spent -= held.popleft()[1]
                # Nothing before the start is blocked, though its own window is not all here.
                over = micros[i] >= episode[0] and nano[i] > 0 and spent + nano[i] > cap[i]
                blocked.append(over)
                if not over:
                    held.append((micros[i], nano[i]))
                    spent += nano[i]
            yield batch.filter(pa.array(blocked, pa.bool_()))

    return fold


def blocked_instants(totals: DataFrame, keys: Sequence[str], hours: int) -> DataFrame:
    """Keys and ``_at`` of the instants a cap blocks when blocked spend does not count.

    ``totals`` has one row per key and instant: ``_change``, ``_rolling`` with all
    spend counted, and ``_cap``. An instant is blocked when it spends and would bring what
    counted of the ``hours`` before it, both ends included, over the cap.

    One episode is one task, read in order with the instants of one window in
    memory; users, surfaces and episodes are independent of each other.
    """
    over = totals.where(F.col("_rolling") > F.col("_cap")).select(*keys, "_at")
    window = F.expr(f"INTERVAL {int(hours)} HOUR")
    # An episode needs the window before it. Those of one key do not meet, since the gap
    # between two is longer than that.
    spans = episodes(over, keys, hours).select(
        *[F.col(k).alias(f"_{k}") for k in keys], "_start", "_end",
        _hours(F.col("_start") - window, F.col("_end")).alias("_span_hour"),
    )
    within = (
        (F.date_trunc("hour", F.col("_at")) == F.col("_span_hour"))
        & (F.col("_at") >= F.col("_start") - window)
        & (F.col("_at") <= F.col("_end"))
    )
    for key in keys:
        within &= F.col(key).eqNullSafe(F.col(f"_{key}"))
    nano = F.lit(1_000_000_000)
    rows = totals.join(spans, within).select(
        F.unix_micros(F.col("_start").cast("timestamp")).alias("_episode"), *keys, "_at",
        F.unix_micros(F.col("_at").cast("timestamp")).alias("_micros"),
        (F.col("_change") * nano).cast("bigint").alias("_nano"),
        (F.col("_cap") * nano).cast("bigint").alias("_cap"),
    )
    order = ("_episode", *keys)
    return (
        rows.repartition(*order)
        .sortWithinPartitions(*order, "_at")
        .mapInArrow(_fold(len(keys), hours), rows.schema)
        .select(*keys, "_at")
    )
