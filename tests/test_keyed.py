"""Keyed tables: updates against a dict, and runs that die on the way."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from spendlens.sources import keyed

ROWS = "id bigint, text string, score double"
NOW = datetime(2024, 1, 31)


def held(spark, path):
    return sorted((tuple(r) for r in keyed.read_keyed(spark, path).collect()), key=repr)


@pytest.fixture
def path(spark, tmp_path):
    where = str(tmp_path / "table")
    rows = [(i, f"text {i}", None) for i in range(50)] + [(None, "no key", None)]
    keyed.create_keyed(spark.createDataFrame(rows, ROWS), where, "id", buckets=16)
    return where


def test_updates_against_a_dict(spark, path):
    rng = random.Random(2)
    want = {i: (f"text {i}", None) for i in range(50)} | {None: ("no key", None)}
    for _ in range(4):
        ids = rng.sample(range(80), 6) + [None] * rng.randrange(2)
        new = [(i, rng.random()) for i in ids]
        keyed.upsert(spark.createDataFrame(new, "id bigint, score double"), path)
        for i, score in new:
            want[i] = (want.get(i, (None, None))[0], score)
    assert held(spark, path) == sorted(((i, *v) for i, v in want.items()), key=repr)


def test_processed_at_round_trip(spark, path):
    keyed.upsert(spark.createDataFrame([(3, None)], "id bigint, processed_at timestamp"), path)
    open_rows = F.col("processed_at").isNull() & (F.col("id") < 10)
    keyed.update_where(spark, path, open_rows, {"processed_at": F.lit(str(NOW)).cast("timestamp")})
    rows = keyed.read_keyed(spark, path).collect()
    assert {r.id for r in rows if r.processed_at == NOW} == set(range(10))
    assert keyed.update_where(spark, path, open_rows, {"processed_at": F.lit("2030-01-01")}) == []
    assert held(spark, path) == sorted((tuple(r) for r in rows), key=repr)
    with pytest.raises(ValueError, match="keys"):
        keyed.update_where(spark, path, F.lit(True), {"id": F.lit(1)})


def test_only_touched_buckets_are_rewritten(spark, path):
    before = keyed.manifest(spark, path).folders
    touched = keyed.upsert(spark.createDataFrame([(7, 1.0)], "id bigint, score double"), path)
    after = keyed.manifest(spark, path).folders
    assert len(touched) == 1 and {b for b in after if after[b] != before.get(b)} == set(touched)


def test_update_without_insert_and_repeated_keys(spark, path):
    changes = [(5, "a", 1), (5, "b", 3), (5, "c", 2), (500, "new", 9)]
    df = spark.createDataFrame(changes, "id bigint, text string, at int")
    keyed.upsert(df, path, newest="at", insert=False)
    rows = {r.id: (r.text, r["at"]) for r in keyed.read_keyed(spark, path).collect()}
    assert rows[5] == ("b", 3) and 500 not in rows and len(rows) == 51
    assert keyed.upsert(spark.createDataFrame([], "id bigint, score double"), path) == []


@pytest.mark.parametrize("where", ["store", "commit"])
def test_a_run_that_dies_leaves_the_old_rows(spark, path, monkeypatch, where):
    old = held(spark, path)
    changes = spark.createDataFrame([(i, 1.0) for i in range(60)], "id bigint, score double")
    real = getattr(keyed, where)

    def dies(*args):
        if where == "store":
            real(*args)  # all files are written, nothing committed
        raise KeyboardInterrupt

    monkeypatch.setattr(keyed, where, dies)
    with pytest.raises(KeyboardInterrupt):
        keyed.upsert(changes, path)
    assert held(spark, path) == old
    monkeypatch.undo()
    for _ in range(2):
        keyed.upsert(changes, path)
        rows = {r.id: r.score for r in keyed.read_keyed(spark, path).collect()}
        assert rows == {i: 1.0 for i in range(60)} | {None: None}


def test_the_second_of_two_writers_changes_nothing(spark, path):
    state = keyed.manifest(spark, path)
    keyed.upsert(spark.createDataFrame([(1, 1.0)], "id bigint, score double"), path)
    now = held(spark, path)
    with pytest.raises(RuntimeError, match="another writer"):
        keyed.commit(spark, path, keyed.replace(state, number=state.number + 1, folders={}))
    assert held(spark, path) == now
    with pytest.raises(FileExistsError):
        keyed.create_keyed(spark.createDataFrame([], ROWS), path, "id")


def test_vacuum_keeps_what_is_used(spark, path):
    for i in range(4):
        keyed.upsert(spark.createDataFrame([(i, 1.0)], "id bigint, score double"), path)
    now = held(spark, path)
    keyed.vacuum(spark, path, keep=1)
    assert held(spark, path) == now and keyed.vacuum(spark, path, keep=1) == 0


def test_empty_and_missing(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        keyed.read_keyed(spark, str(tmp_path / "none"))
    where = str(tmp_path / "empty")
    keyed.create_keyed(spark.createDataFrame([], ROWS), where, ["id", "text"], buckets=4)
    assert held(spark, where) == []
    keyed.upsert(spark.createDataFrame([(1, "a", 2.0), (1, "b", 3.0)], ROWS), where)
    assert held(spark, where) == [(1, "a", 2.0), (1, "b", 3.0)]
