"""Look up one value per key when a few keys own most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(groups: DataFrame, key: str, count: str) -> DataFrame:
    """Keys with more rows than an even share of a shuffle partition, and the parts to cut each into.

    ``groups`` has one row and a count per key. A key is hot when it owns more than
    1/p of all rows, p being the number of shuffle partitions, so there are fewer than
    p of them whatever the data, and their parts come to fewer than 2 p.
    """
    p = _partitions(groups)
    total = groups.agg(F.sum(count)).scalar()
    share = F.col(count) * p
    return groups.where(share > total).select(
        key, F.ceil(share / total).cast("int").alias("parts")
    )


def lookup(
    rows: DataFrame, values: DataFrame, key: str, hot: DataFrame, row_id: str
) -> DataFrame:
    """Left join of ``rows`` with ``values`` (one row per key) on ``key``.

    Rows of a hot key are spread over its parts by ``row_id`` and its value is copied
    to each part; rows without a key are spread over all partitions. Only the list of
    hot keys is broadcast, which has fewer rows than there are shuffle partitions.
    ``values`` is evaluated once.
    """
    marked = F.broadcast(hot.select(F.col(key).alias("_hot"), F.col("parts").alias("_parts")))
    spread = F.coalesce("_parts", F.when(F.col(key).isNull(), F.lit(_partitions(rows))), F.lit(1))
    left = (
        rows.join(marked, F.col(key) == F.col("_hot"), "left")
        .withColumn("_part", F.pmod(F.xxhash64(row_id), spread).cast("int"))
        .drop("_hot", "_parts")
    )
    parts = F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)
    right = (
        values.join(marked, F.col(key) == F.col("_hot"), "left")
        .withColumn("_part", F.explode(parts))
        .drop("_hot", "_parts")
    )
    return left.join(right, [key, "_part"], "left").select(
        *rows.columns, *[c for c in values.columns if c != key]
    )
