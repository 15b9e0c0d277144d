"""The ledger against a set of keys, and what a small batch reads of it."""

import random
import re

import pytest
from pyspark.sql import types as T

from spendlens.sources import ledger as ledger_module
from spendlens.sources.ledger import Ledger

KEY = T.StructField("doc_id", T.LongType())


def rows(spark, keys):
    return spark.createDataFrame([(k, f"row {k}") for k in keys], "doc_id bigint, text string")


def new(ledger, spark, keys):
    return sorted((r.doc_id for r in ledger.new_rows(rows(spark, keys)).collect()), key=repr)


@pytest.mark.parametrize("bits", [64, 1 << 17])
def test_against_a_set(spark, tmp_path, bits):
    rng = random.Random(bits)
    ledger, held = Ledger(spark, str(tmp_path / "l"), KEY, buckets=8, bits=bits), set()
    assert new(ledger, spark, [1, 1, None]) == [1, 1, None]
    for _ in range(3):
        batch = [rng.randrange(300) for _ in range(60)] + [None] * rng.randrange(2)
        assert new(ledger, spark, batch) == sorted((k for k in batch if k not in held), key=repr)
        ledger.append(rows(spark, batch))
        held |= set(batch)
    assert new(ledger, spark, sorted(k for k in held if k is not None)) == []
    again = Ledger(spark, str(tmp_path / "l"), KEY, buckets=8, bits=bits)
    assert again.known(rows(spark, range(300))).count() == len([k for k in held if k is not None])


def test_a_small_batch_reads_few_buckets_and_moves_nothing_of_the_ledger(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "l"), KEY, buckets=64, bits=1 << 17)
    ledger.append(rows(spark, range(20_000)))
    fresh, old = list(range(50_000, 50_100)), [7, 8]
    assert ledger.suspects(rows(spark, fresh)).count() <= 5
    batch = rows(spark, fresh + old)
    known = ledger.known(batch)
    assert sorted(r.doc_id for r in known.collect()) == old
    plan = known._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "doc_id" in line and "PartitionFilters: [_bucket" in line)
    touched = re.search(r"_bucket#\d+ IN \(([^)]*)\)", scan)
    touched = touched.group(1).split(",") if touched else re.findall(r"_bucket#\d+ = (\d+)", scan)
    assert 1 <= len(touched) <= 7
    above = plan[: plan.index(scan)].splitlines()
    depth, joined = len(scan) - len(scan.lstrip(" :+-")), False
    for line in reversed(above):
        here = len(line) - len(line.lstrip(" :+-"))
        if here < depth:
            depth = here
            joined = joined or "Join" in line
            assert joined or "Exchange" not in line, plan
    assert joined


def test_many_suspects_are_joined(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledger_module, "MOST_SENT", 3)
    ledger = Ledger(spark, str(tmp_path / "l"), KEY, buckets=4)
    ledger.append(rows(spark, range(20)))
    assert new(ledger, spark, range(10, 30)) == list(range(20, 30))


def test_a_run_that_dies_between_its_writes_is_repeated(spark, tmp_path, monkeypatch):
    ledger = Ledger(spark, str(tmp_path / "l"), KEY, buckets=4)
    ledger.append(rows(spark, [1]))
    # Only the filters of the next run were written.
    other = Ledger(spark, str(tmp_path / "o"), KEY, buckets=4)
    other.append(rows(spark, [2, 3]))
    spark.read.parquet(f"{other.path}/filters").write.mode("append").partitionBy("_bucket").parquet(f"{ledger.path}/filters")
    assert new(ledger, spark, [1, 2, 3]) == [2, 3]
    ledger.append(rows(spark, [2, 3]))
    ledger.append(rows(spark, [2, 3]))
    assert new(ledger, spark, [1, 2, 3, 4]) == [4]
