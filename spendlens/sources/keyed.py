"""Keyed tables: rows that can be updated by key, on plain files.

A table is cut into buckets by the hash of its key. A change is a new copy of the
buckets it touches, all others stay as they are. Which copy of each bucket counts is
written in a manifest; the manifest with the highest number is the table, and
putting the next one in place is the only step that changes it. A run that dies
before leaves the old rows, one that dies after the new ones, and running it again
gives the same table.

One writer at a time: the number of the next manifest can be taken once, and
whoever comes second gets an error and has changed nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlens.sources.files import Files, read_numbered

#: Column and folder name of the bucket.
BUCKET = "_bucket"


@dataclass(frozen=True)
class Manifest:
    """One state of a table: its columns, and the folder of each bucket that has rows."""

    number: int
    keys: tuple[str, ...]
    buckets: int
    schema: T.StructType
    folders: Mapping[int, str]
    #: The last batch of a stream this state holds.
    batch: int = -1

    def text(self) -> str:
        return json.dumps({
            "keys": self.keys, "buckets": self.buckets, "schema": self.schema.jsonValue(),
            "folders": {str(b): f for b, f in sorted(self.folders.items())}, "batch": self.batch,
        })

    @classmethod
    def parsed(cls, number: int, text: str) -> Manifest:
        d = json.loads(text)
        folders = {int(b): f for b, f in d["folders"].items()}
        return cls(number, tuple(d["keys"]), d["buckets"], T.StructType.fromJson(d["schema"]), folders, d["batch"])


def _folder(path: str) -> str:
    return path.rstrip("/")


def manifest(spark: SparkSession, path: str) -> Manifest:
    """The present state of a table."""
    path = _folder(path)
    numbers = Files(spark, path).numbers(f"{path}/manifests")
    if not numbers:
        raise FileNotFoundError(f"{path} holds no keyed table")
    return _at(spark, path, numbers[-1])


def _at(spark: SparkSession, path: str, number: int) -> Manifest:
    return Manifest.parsed(number, read_numbered(spark, f"{path}/manifests", number))


def commit(spark: SparkSession, path: str, state: Manifest) -> None:
    Files(spark, path).put(f"{path}/manifests", state.number, state.text())


def read_buckets(spark: SparkSession, path: str, state: Manifest, buckets: Sequence[int] | None = None) -> DataFrame:
    """Rows of the given buckets, or of all; older copies give NULL for newer columns."""
    chosen = state.folders if buckets is None else {b: state.folders[b] for b in buckets if b in state.folders}
    with_bucket = T.StructType([*state.schema.fields, T.StructField(BUCKET, T.IntegerType())])
    if not chosen:
        return spark.createDataFrame([], with_bucket)
    folders = [f"{path}/data/{f}/{BUCKET}={b}" for b, f in sorted(chosen.items())]
    # One read per copy: a folder of several copies would be two partitions of one name.
    reader = spark.read.schema(with_bucket)
    parts = [
        reader.option("basePath", f"{path}/data/{copy}").parquet(*[x for x in folders if x.startswith(f"{path}/data/{copy}/")])
        for copy in sorted(set(chosen.values()))
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def store(rows: DataFrame, path: str, state: Manifest, touched: Sequence[int]) -> Manifest:
    """Write new copies of the touched buckets; the state that counts them in, not yet committed."""
    spark, copy = rows.sparkSession, uuid.uuid4().hex
    target = f"{path}/data/{copy}"
    rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(target)
    written = {int(n.partition("=")[2]) for n in Files(spark, path).names(target) if n.startswith(BUCKET)}
    kept = {b: f for b, f in state.folders.items() if b not in set(touched)}
    return replace(state, number=state.number + 1, folders=kept | {b: copy for b in written})


def _one_per_key(rows: DataFrame, keys: Sequence[str], newest: str | None) -> DataFrame:
    """One row per key: that with the greatest ``newest``, then the greatest row."""
    others = [c for c in rows.columns if c not in keys]
    if not others:
        return rows.distinct()
    order = F.struct(*([F.col(newest).alias("_newest")] if newest else []), *others)
    return rows.groupBy(*keys).agg(F.max(order).alias("_row")).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others])


def create_keyed(df: DataFrame, path: str, keys: str | Sequence[str], buckets: int = 64, newest: str | None = None) -> None:
    """Start a table with the rows of ``df``, one per key; a key may be NULL like any other."""
    path, keys = _folder(path), (keys,) if isinstance(keys, str) else tuple(keys)
    spark = df.sparkSession
    if Files(spark, path).numbers(f"{path}/manifests"):
        raise FileExistsError(f"{path} already holds a keyed table")
    state = Manifest(0, keys, buckets, T.StructType([nullable(f) for f in df.schema]), {})
    rows = _one_per_key(df, keys, newest).select(*df.columns, bucket_of(keys, buckets).alias(BUCKET))
    commit(spark, path, store(rows, path, state, []))


def nullable(field: T.StructField) -> T.StructField:
    return T.StructField(field.name, field.dataType, True)


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a table as they are now."""
    path = _folder(path)
    state = manifest(spark, path)
    return read_buckets(spark, path, state).select(*state.schema.names)


def upsert(changes: DataFrame, path: str, newest: str | None = None, insert: bool = True) -> list[int]:
    """Set the columns of ``changes`` in the rows of its keys; the buckets that were rewritten.

    ``changes`` has the keys and any other columns; those the table doesn't have yet
    are added, those it doesn't name keep their values. Keys the table lacks become
    new rows, or with ``insert`` false are left out. Of several rows of a key that with
    the greatest ``newest`` counts, then the greatest row.

    Only buckets that hold a changed key are read and written, and changes meet old
    rows by key and bucket.
    """
    path, spark = _folder(path), changes.sparkSession
    state = manifest(spark, path)
    keys = list(state.keys)
    known = state.schema.names
    added = [nullable(f) for f in changes.schema if f.name not in known]
    schema = T.StructType([*state.schema.fields, *added])
    types = {f.name: f.dataType for f in schema}
    new = _one_per_key(changes.select(*[F.col(c).cast(types[c]) for c in changes.columns]), keys, newest)
    new = new.withColumn(BUCKET, bucket_of(keys, state.buckets))
    # Bucket numbers only, so no more rows than buckets.
    touched = sorted(r[BUCKET] for r in new.select(BUCKET).distinct().collect())
    if not insert:
        touched = [b for b in touched if b in state.folders]
    if not touched:
        return []
    state = replace(state, schema=schema)
    old = read_buckets(spark, path, state, touched)
    set_ = [c for c in changes.columns if c not in keys]
    other = new.where(F.col(BUCKET).isin(touched)).select(
        *[F.col(k).alias(f"_{k}") for k in keys], F.col(BUCKET).alias("_in"), F.lit(True).alias("_new"),
        *[F.col(c).alias(f"_{c}") for c in set_],
    )
    same = F.col(BUCKET) == F.col("_in")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    met = old.withColumn("_old", F.lit(True)).join(other, same, "full" if insert else "left")
    rows = met.select(
        *[
            F.when(F.col("_new"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in set_
            else F.when(F.col("_old"), F.col(c)).otherwise(F.col(f"_{c}")).alias(c) if c in keys
            else F.col(c)
            for c in schema.names
        ],
        F.coalesce(BUCKET, "_in").alias(BUCKET),
    )
    commit(spark, path, store(rows, path, state, touched))
    return touched


def update_where(spark: SparkSession, path: str, condition: Column, values: Mapping[str, Column]) -> list[int]:
    """Set columns in all rows that meet a condition; the buckets that were rewritten.

    A first scan of the condition's columns finds the buckets, which alone are rewritten.
    """
    path = _folder(path)
    state = manifest(spark, path)
    whole = read_buckets(spark, path, state)
    touched = sorted(r[BUCKET] for r in whole.where(condition).select(BUCKET).distinct().collect())
    if not touched:
        return []
    if set(values) & set(state.keys):
        raise ValueError("keys cannot be set")
    types = {f.name: f.dataType for f in state.schema}
    hit = F.coalesce(condition, F.lit(False))
    rows = read_buckets(spark, path, state, touched).select(
        *[F.when(hit, values[c].cast(types[c])).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in types],
        BUCKET,
    )
    commit(spark, path, store(rows, path, state, touched))
    return touched


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Remove copies that none of the last ``keep`` states uses; their number.

    To be run while nobody writes or reads an older state.
    """
    path = _folder(path)
    files = Files(spark, path)
    numbers = files.numbers(f"{path}/manifests")
    used = {f for n in numbers[-keep:] for f in _at(spark, path, n).folders.values()}
    for n in numbers[:-keep]:
        files.drop(f"{path}/manifests/{n:012}.json")
    gone = [n for n in files.names(f"{path}/data") if n not in used]
    for name in gone:
        files.drop(f"{path}/data/{name}")
    return len(gone)
