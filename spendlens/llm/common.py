"""What several operators share: stored intermediate tables, batches of texts, row identity."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A document id above all others, for rows without one.
NO_ID = (1 << 63) - 1

#: The 26 letters A-Z to lower case, every other byte as it is.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared folder named by ``spark.checkpoint.dir``.

    Only a session on one machine may leave the setting out; it gets a
    temporary folder. Elsewhere executors could not read each other's files.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, lineage cut.

    A lost executor loses nothing of it, since the files are in shared storage.
    """
    folder = work_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def text_key(text: str = "text") -> Column:
    """Two 64-bit hashes of a text as one struct: with the id, the identity of a row."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))


def held_out(id_col: str = "doc_id") -> Column:
    """True for the ids whose labels are never used: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def replacing(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns of these names, in any case, so that they can be added."""
    taken = {n.lower() for n in names}
    return df.select(*[df[c] for c in df.columns if c.lower() not in taken])


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The given names, each made longer until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        found.append(name)
    return found


def matched(
    docs: DataFrame, rows: DataFrame, how: str, id_col: str, text_col: str, once: bool = False
) -> DataFrame:
    """Semi or anti join of documents with ``rows`` (id, key) on id and text, null ids included.

    ``key`` is the ``text_key`` of a text. With ``once``, rows that repeat id and text become one.
    """
    id_name, key_name, own = fresh(docs, "_id", "_key", "_own_key")
    other = rows.select(F.col("id").alias(id_name), F.col("key").alias(key_name))
    met = docs.withColumn(own, text_key(text_col)).join(
        other,
        F.col(id_col).cast("bigint").eqNullSafe(F.col(id_name)) & (F.col(own) == F.col(key_name)),
        how,
    )
    return (met.dropDuplicates([id_col, own]) if once else met).select(*docs.columns)


def encoded(texts: Iterable) -> Iterator[bytes]:
    """The UTF-8 bytes of each Arrow string, empty for null."""
    for value in texts:
        text = value.as_py()
        yield b"" if text is None else text.encode("utf-8", "surrogatepass")


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every output bit depends on every input bit."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))
