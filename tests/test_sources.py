"""Stored logs, rollups and ledgers."""

import pytest
from pyspark.sql import functions as F

from spendlens.operators import prompts, tracking
from spendlens.plans.rollup import hourly_rollup
from spendlens.sources import logs
from checks.fixtures import AS_OF
from tests.util import rows


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_log_round_trip(spark, tables, tmp_path, fmt):
    calls = tables.ai_function_usage.withColumn("start_time", F.col("start_time").cast("timestamp"))
    logs.write_log(calls, str(tmp_path), "start_time", fmt=fmt)
    stored = logs.read_log(spark, str(tmp_path), "ai_function_usage", fmt)
    assert "event_date" in stored.columns
    for days in (1, 7, 30):
        assert rows(tracking.spend_by_function(stored, AS_OF, days)) == rows(
            tracking.spend_by_function(calls, AS_OF, days)
        )


def test_csv_is_read_with_the_canonical_schema(spark, tmp_path):
    spark.createDataFrame([(1, "ann")], "user_id int, name string").write.csv(
        str(tmp_path / "u"), header=True
    )
    users = logs.read_log(spark, str(tmp_path / "u"), "users", "csv", header=True)
    assert rows(users) == [(1, "ann")]
    assert users.schema["user_id"].dataType.simpleString() == "bigint"
    with pytest.raises(ValueError, match="not one of"):
        logs.read_log(spark, str(tmp_path / "u"), "users", "xml")


def test_catalog_table(spark, tables):
    tables.users.createOrReplaceTempView("known_users")
    assert logs.read_table(spark, "known_users", "users").count() == tables.users.count()
    spark.catalog.dropTempView("known_users")


def test_rollup_refresh_replaces_only_its_days(spark, tables, tmp_path):
    calls = tables.ai_function_usage
    path = str(tmp_path / "rollup")
    logs.refresh_rollup(calls, path, "start_time", "credits")
    first = rows(tracking.spend_by_function(spark.read.parquet(path), AS_OF, days=60))
    doubled = calls.unionByName(calls)
    logs.refresh_rollup(doubled, path, "start_time", "credits", since="2024-01-25")
    logs.refresh_rollup(doubled, path, "start_time", "credits", since="2024-01-25")
    expected = calls.unionByName(calls.where("start_time >= '2024-01-25'"))
    got = rows(tracking.spend_by_function(spark.read.parquet(path), AS_OF, days=60))
    assert got == rows(tracking.spend_by_function(expected, AS_OF, days=60)) != first


def test_rollup_is_one_row_per_key(tables):
    rollup = hourly_rollup(tables.ai_sql_usage, "usage_time", "token_credits")
    assert rollup.select("hour", "user_id", "function_name", "model_name").distinct().count() == (
        rollup.count()
    )


def test_ledger(spark, tables, tmp_path):
    path = str(tmp_path / "ledger")
    documents = tables.documents.select("doc_id", "text")
    for part in ("doc_id < 50", "doc_id < 120"):
        ledger = logs.read_ledger(spark, path, "doc_id bigint")
        new = prompts.new_rows_only(documents.where(part), ledger)
        seen = new.count()
        logs.append_ledger(new, path, "doc_id")
    assert seen == 70
    assert logs.read_ledger(spark, path, "doc_id bigint").count() == 120
