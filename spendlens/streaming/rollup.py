"""The hourly rollup kept by a stream, late calls included.

Each batch is rolled up by itself and merged into the days it touches. Those days are
written anew beside the old ones, and one manifest puts them in place together with
the number of the batch. A batch that is repeated after a failure finds its number
there and changes nothing, so every call counts exactly once, however late.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from spendlens.functions.time import EVENT_DATE
from spendlens.plans.rollup import hourly_rollup, merged_rollups
from spendlens.sources import keyed

#: Folder of hours without a time.
_NO_DAY = -(1 << 31)


def _bucketed(rollup: DataFrame) -> DataFrame:
    """Days since 1970 as the bucket of a rollup's rows."""
    day = F.datediff(EVENT_DATE, F.lit("1970-01-01").cast("date"))
    return rollup.withColumn(keyed.BUCKET, F.coalesce(day, F.lit(_NO_DAY)))


def merge_batch(batch: DataFrame, batch_id: int, path: str, time_col: str, credit_col: str) -> bool:
    """Add the calls of one batch to the stored rollup; False where it already has them."""
    spark, path = batch.sparkSession, path.rstrip("/")
    delta = hourly_rollup(batch, time_col, credit_col)
    try:
        state = keyed.manifest(spark, path)
    except FileNotFoundError:
        schema = T.StructType([keyed.nullable(f) for f in delta.schema])
        state = keyed.Manifest(-1, ("hour", "user_id", "function_name", "model_name"), 0, schema, {})
    if state.batch >= batch_id:
        return False
    delta = _bucketed(delta).persist()
    try:
        # One number per day.
        touched = sorted(r[keyed.BUCKET] for r in delta.select(keyed.BUCKET).distinct().collect())
        old = keyed.read_buckets(spark, path, state, touched)
        whole = merged_rollups(old.unionByName(delta)).select(*state.schema.names)
        state = keyed.store(_bucketed(whole), path, state, touched)
        keyed.commit(spark, path, replace(state, batch=batch_id))
    finally:
        delta.unpersist()
    return True


def write_rollup(
    calls: DataFrame, path: str, checkpoint: str, time_col: str, credit_col: str, available_now: bool = False
) -> StreamingQuery:
    """Start the query that keeps the rollup at ``path`` up to date with a stream of calls.

    One query writes a rollup. ``read_rollup`` gives reports a state in which each batch
    counts wholly or not at all.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        merge_batch(batch, batch_id, path, time_col, credit_col)

    writer = calls.writeStream.option("checkpointLocation", checkpoint).foreachBatch(apply)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    """The rollup as it is now; reports take it in place of the log."""
    return keyed.read_keyed(spark, path)
