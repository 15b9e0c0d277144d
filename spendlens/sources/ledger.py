"""A ledger of processed keys that a small batch can be held against without reading all of it.

Keys lie in buckets by their hash. Each bucket has a Bloom filter, kept as bitmaps that
Spark builds and unites itself. A batch first meets the bitmaps: a key that lacks a mark
was never processed. Only keys that have all marks are looked up, and only their
buckets are read. Few suspects are sent to the ledger, so nothing of it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

#: Marks of a key: with ten bits per key one unknown key in a hundred has all of them.
MARKS = 4

#: Suspects up to this many, counted beforehand, are sent to the ledger; more are joined by shuffles.
MOST_SENT = 1_000_000

_BUCKET = "_bucket"


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _marked(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """One row per mark of a key: its bucket, block of the filter and bit, counted from 1."""
    places = F.array(*[F.pmod(F.xxhash64(F.lit(i), F.col(key)), F.lit(bits)) + 1 for i in range(MARKS)])
    marked = keys.select(key, _BUCKET, F.explode(F.array_distinct(places)).alias("_place"))
    return marked.select(
        key, _BUCKET, F.bitmap_bucket_number("_place").alias("_block"), F.bitmap_bit_position("_place").alias("_bit")
    )


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


class Ledger:
    """Processed keys in a folder. ``buckets`` and ``bits`` (of each filter) belong to the folder.

    Take about ten bits for each key a bucket is to hold; a filter that fills up lets
    more keys through to the look-up, and the result stays the same. NULL is a key.
    """

    def __init__(self, spark: SparkSession, path: str, key: T.StructField, buckets: int = 256, bits: int = 1 << 20) -> None:
        self.spark, self.path, self.key = spark, path.rstrip("/"), key.name
        self.buckets, self.bits = buckets, bits
        part = T.StructField(_BUCKET, T.IntegerType())
        self._keys = T.StructType([T.StructField(key.name, key.dataType), part])
        self._filters = T.StructType([T.StructField("_block", T.LongType()), T.StructField("_bits", T.BinaryType()), part])

    def _placed(self, rows: DataFrame) -> DataFrame:
        return rows.select(self.key).distinct().withColumn(_BUCKET, _bucket(F.col(self.key), self.buckets))

    def append(self, rows: DataFrame) -> None:
        """Add the keys of processed rows. A run that dies is repeated; keys held twice do no harm.

        Filters are written first: a key without its marks would be taken for new.
        """
        keys = self._placed(rows)
        built = _marked(keys, self.key, self.bits).groupBy(_BUCKET, "_block").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
        built.hint("rebalance", _BUCKET).write.mode("append").partitionBy(_BUCKET).parquet(f"{self.path}/filters")
        keys.hint("rebalance", _BUCKET).write.mode("append").partitionBy(_BUCKET).parquet(f"{self.path}/keys")

    def suspects(self, rows: DataFrame) -> DataFrame:
        """Keys of ``rows`` that have all marks, with their buckets: processed ones and few others."""
        marked = _marked(self._placed(rows), self.key, self.bits)
        filters = _read(self.spark, f"{self.path}/filters", self._filters)
        united = filters.groupBy(_BUCKET, "_block").agg(F.bitmap_or_agg("_bits").alias("_bits"))
        octet = F.substring("_bits", (F.col("_bit") / 8).cast("int") + 1, F.lit(1))
        value = F.conv(F.hex(octet), 16, 10).cast("int")
        hit = F.getbit(value, (F.col("_bit") % 8).cast("int")) == 1
        met = marked.join(united, [_BUCKET, "_block"], "left")
        return (
            met.groupBy(self.key, _BUCKET).agg(F.min(F.coalesce(hit, F.lit(False))).alias("_all"))
            .where("_all").select(self.key, _BUCKET)
        )

    def known(self, rows: DataFrame) -> DataFrame:
        """The keys of ``rows`` that were processed. Reads the buckets of suspects only."""
        suspects = self.suspects(rows)
        # One row per bucket.
        counts = {r[_BUCKET]: r["count"] for r in suspects.groupBy(_BUCKET).count().collect()}
        held = _read(self.spark, f"{self.path}/keys", self._keys).where(F.col(_BUCKET).isin(list(counts)))
        asked = suspects.select(F.col(self.key).alias("_key"))
        if sum(counts.values()) <= MOST_SENT:
            asked = F.broadcast(asked)
        same = F.col(self.key).eqNullSafe(F.col("_key"))
        return held.join(asked, same, "left_semi").select(self.key).distinct()

    def new_rows(self, rows: DataFrame) -> DataFrame:
        """Rows whose key was not processed, as they are."""
        known = self.known(rows).select(F.col(self.key).alias("_known"))
        return rows.join(known, F.col(self.key).eqNullSafe(F.col("_known")), "left_anti")
