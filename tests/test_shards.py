"""Keys dealt to shards come back as they were, and each is walked alone."""

from datetime import date, datetime, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from spendlens.streaming import shards, sinks, spend

START = datetime(2024, 3, 1)


def _count():
    def walk(state, rows):
        seen = (state[0] if state else 0) + len(rows)
        return (seen,), [(rows[-1][0], seen)]

    def due(state):
        return None

    def lapse(state):
        return state, []

    return walk, due, lapse


def test_keys_of_any_type_come_back(spark, tmp_path):
    schema = "s string, l bigint, d decimal(38,9), x double, at timestamp_ntz, day date, b binary"
    keys = [
        ('"a",\\\né中', 2**63 - 1, Decimal("12345678901234567890123456789.000000001"), 0.1, START + timedelta(microseconds=1), date(1900, 1, 1), b"\x00\xff"),
        ('"a",\\\né中', 2**63 - 1, Decimal("12345678901234567890123456789.000000001"), 0.1, START + timedelta(microseconds=2), date(1900, 1, 1), b"\x00\xff"),
        ("", -(2**53) - 1, None, float("nan"), None, None, b""),
        (None, -(2**53), None, float("-inf"), None, None, None),
        (None, None, None, None, None, None, None),
    ]
    rows = [(*k, START + timedelta(seconds=i)) for i, k in enumerate(keys * 3)]
    given = spark.createDataFrame(rows, f"{schema}, t timestamp")
    given.coalesce(1).write.parquet(str(tmp_path / "in"))
    names = [f.split()[0] for f in schema.split(", ")]
    stream = spend.read_calls(spark, str(tmp_path / "in"), given.schema).withWatermark("t", "1 minute")
    stream = stream.withColumn("n", F.unix_micros("t"))
    with spend.rocksdb_state(spark):
        found = shards.walk_keys(stream, names, "t", ["n"], "seen bigint", "n bigint, seen bigint", *_count(), shards=2)
        assert [f.dataType for f in found.schema][: len(names)] == [given.schema[n].dataType for n in names]
        got = sinks.drain_rows(found, str(tmp_path / "o"))
    want = given.select(*names).distinct().withColumn("seen", F.lit(3).cast("bigint"))
    assert got.count() == len(keys)
    assert got.select(*names, "seen").exceptAll(want).count() == 0
