"""Where streams keep checkpoints and results, and how update results are read."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

CHECKPOINT_DIR = "spark.checkpoint.dir"
_BATCH, _CHANGES, _STATE = "batch_id", "changes", "state"

#: Batches between two compactions of an update-mode result.
COMPACT_EVERY = 20


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the checkpoint folder the cluster names.

    Without the setting there is no folder that all executors are known to share.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors can reach")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of a folder of batches, none where nothing was stored yet."""
    with_batch = T.StructType([*schema.fields, T.StructField(_BATCH, T.LongType())])
    try:
        return spark.read.schema(with_batch).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], with_batch)


def _latest(spark: SparkSession, path: str, keys: Sequence[str], schema: T.StructType) -> DataFrame:
    """Last row per key: the newest compacted state, and the batches after it.

    Folders up to that state are cut by their name, without being read.
    """
    fields = [f.name for f in schema if f.name not in keys]
    states = _stored(spark, f"{path}/{_STATE}", schema)
    upto = states.agg(F.coalesce(F.max(_BATCH), F.lit(-1)).alias("upto")).first()["upto"]
    rows = states.where(F.col(_BATCH) == upto).unionByName(
        _stored(spark, f"{path}/{_CHANGES}", schema).where(F.col(_BATCH) > upto)
    )
    return (
        rows.groupBy(*keys)
        .agg(F.max_by(F.struct(*fields), _BATCH).alias("last"))
        .select(*keys, *[F.col("last")[f].alias(f) for f in fields])
    )


def write_updates(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    available_now: bool = False,
    compact_every: int = COMPACT_EVERY,
) -> StreamingQuery:
    """Start an update-mode query that stores each batch's changed rows.

    A batch owns the folder of its id and overwrites it, so a batch that is
    repeated after a failure leaves the same rows. Every ``compact_every`` batches the
    last row per key is stored as one state, so a reader takes that and fewer batches
    than ``compact_every``, however long the stream has run. Older folders are
    no longer read and may be removed.
    """
    schema = stream.schema

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{path}/{_CHANGES}/{_BATCH}={batch_id}")
        if (batch_id + 1) % compact_every == 0:
            state = _latest(spark, path, keys, schema)
            state.write.mode("overwrite").parquet(f"{path}/{_STATE}/{_BATCH}={batch_id}")

    writer = (
        stream.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(store)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_updates(spark: SparkSession, path: str, keys: list[str], schema) -> DataFrame:
    """Current state of an update-mode result: the last row stored per key."""
    return _latest(spark, path, keys, schema)


def write_rows(
    stream: DataFrame, path: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Start an append-mode query into parquet files."""
    writer = (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start(path)


def drain_updates(stream: DataFrame, keys: list[str], folder: str) -> DataFrame:
    """Run an update-mode stream over all data that is there; return its state.

    Checkpoint and results stay in ``folder``, which all executors must reach.
    """
    spark = stream.sparkSession
    write_updates(
        stream, f"{folder}/rows", f"{folder}/checkpoint", keys, available_now=True
    ).awaitTermination()
    return read_updates(spark, f"{folder}/rows", keys, stream.schema)


def drain_rows(stream: DataFrame, folder: str) -> DataFrame:
    """Run an append-mode stream over all data that is there; return its rows.

    Checkpoint and results stay in ``folder``, which all executors must reach.
    """
    spark = stream.sparkSession
    write_rows(stream, f"{folder}/rows", f"{folder}/checkpoint", True).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")
