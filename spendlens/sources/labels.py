"""Stored labels of texts, so that a text is scored once per version of its scorer.

The cache is a bucketed table over the hash of a text. Spark reads a bucketed table
already dealt out by that hash, so meeting it moves the hashes that are asked for
and not the cache, however large it has grown.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEXT_HASH, VERSION = "text_hash", "scorer_version"


@dataclass(frozen=True)
class LabelCache:
    """A bucketed table of (text_hash, scorer_version, labels...)."""

    spark: SparkSession
    name: str
    labels: tuple[str, ...]
    buckets: int

    def of(self, version: str) -> DataFrame:
        """Labels by text hash, as one version of the scorer gave them."""
        held = self.spark.table(self.name).where(F.col(VERSION) == version)
        return held.select(TEXT_HASH, *self.labels)

    def add(self, scored: DataFrame, version: str) -> None:
        """Keep the labels of new text hashes. One file per bucket is written.

        A run that dies here may have kept some; the next run scores the others.
        """
        rows = scored.select(TEXT_HASH, F.lit(version).alias(VERSION), *self.labels)
        rows.repartition(self.buckets, TEXT_HASH).write.mode("append").insertInto(self.name)


def open_cache(spark: SparkSession, path: str, labels: T.StructType, buckets: int = 64) -> LabelCache:
    """The cache in a folder, new or as earlier sessions left it.

    ``buckets`` is the width of reads, so take about as many as a large join has
    partitions; it belongs to the folder and must not change.
    """
    path = path.rstrip("/")
    name = f"label_cache_{hashlib.sha256(path.encode()).hexdigest()[:16]}"
    fields = [T.StructField(TEXT_HASH, T.StringType()), T.StructField(VERSION, T.StringType()), *labels.fields]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    where = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({TEXT_HASH}) "
        f"SORTED BY ({TEXT_HASH}) INTO {int(buckets)} BUCKETS LOCATION '{where}'"
    )
    return LabelCache(spark, name, tuple(f.name for f in labels.fields), buckets)
