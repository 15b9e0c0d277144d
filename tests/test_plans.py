"""Shapes the physical plans must have to hold up on large logs."""

import re

import pytest
from pyspark.sql import functions as F

from checks import catalog
from checks.registry import QUERIES
from spendlens.operators import attribution, controls, tracking, waste
from spendlens.plans.running import running_totals
from spendlens.sources import logs
from checks.fixtures import AS_OF
from tests.conftest import SMALL

BATCH = sorted(name for name in QUERIES if not name.startswith("stream_"))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_risky_operators(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if "daily window" not in catalog.TRAITS[name]:
        assert not ("Window [" in plan and re.search(r"Exchange SinglePartition.*\n.*Window", plan))
        assert not re.search(r"Window \[.*\n\W*Sort .*\n\W*Exchange SinglePartition", plan)
    if "python" not in catalog.TRAITS[name]:
        assert "Python" not in plan and "InPandas" not in plan and "InArrow" not in plan


def test_building_queries_runs_no_job(spark, monkeypatch):
    frames, load = {}, catalog.table

    def kept(spark, sf_dir, name):
        if name not in frames:
            frames[name] = load(spark, sf_dir, name)
        return frames[name]

    monkeypatch.setattr(catalog, "table", kept)
    names = [n for n in BATCH if "writes" not in catalog.TRAITS[n]]
    for name in names:
        QUERIES[name](spark, SMALL)  # the first time reads the footers of the files
    for name in names:
        spark.sparkContext.setJobGroup(f"build {name}", name)
        QUERIES[name](spark, SMALL)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(f"build {name}"), name
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("name", ["rolling_cap", "budget_burn_by_team", "dedupe_inputs_mapping", "enrich_new_rows"])
def test_no_broadcast_is_forced_but_the_bounded_one(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        df = QUERIES[name](spark, SMALL)
        df.collect()
        plan = plan_of(df).split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    hot = name in ("dedupe_inputs_mapping", "enrich_new_rows")
    assert ("BroadcastHashJoin" in plan) <= hot


def test_daily_window_sits_on_an_aggregate(tables):
    plan = plan_of(QUERIES["week_over_week"](tables.spark, SMALL))
    assert plan.index("SinglePartition") < plan.index("HashAggregate") < plan.index("FileScan")


@pytest.fixture(scope="module")
def stored(spark, tables, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("log"))
    calls = tables.ai_function_usage.withColumn("start_time", F.col("start_time").cast("timestamp"))
    logs.write_log(calls, path, "start_time")
    # Long enough to print all pushed filters.
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    yield logs.read_log(spark, path, "ai_function_usage")
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_window_prunes_partitions_and_columns(stored):
    plan = plan_of(tracking.spend_by_function(stored, AS_OF, days=7))
    scan = plan[plan.index("FileScan") :]
    partitions = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", scan).group(1)
    assert "event_date" in partitions and "2024-01-24" in partitions
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", scan).group(1)
    assert "GreaterThanOrEqual(start_time" in pushed
    schema = re.search(r"ReadSchema: struct<(.*)", scan).group(1)
    assert "query_id" not in schema and "role_names" not in schema


def reports_on_windows(stored, tables):
    from spendlens.functions.tags import tag_value

    limits = tables.spark.createDataFrame([("t0", 30)], "scope string, credits bigint")
    return {
        "model_allowlist": controls.model_allowlist(stored, "mistral-7b", AS_OF, 7),
        "role_grant_check": controls.role_grant_check(stored, ["ANALYST_ROLE"], AS_OF, 7),
        "project_cost": tracking.project_cost(stored, None, as_of=AS_OF, days=7),
        "project_to_rows": tracking.project_to_rows(stored, as_of=AS_OF, days=7),
        "budget_burn": controls.budget_burn(
            stored, limits, tag_value(F.col("function_name"), "team"), AS_OF, "start_time", "credits"),
        "spend_by_user": attribution.spend_by_user(stored, tables.users, AS_OF),
    }


def test_every_window_prunes_partitions(stored, tables):
    for name, df in reports_on_windows(stored, tables).items():
        plan = plan_of(df)
        scans = [f for f in re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", plan)]
        logs_read = [f for f in scans if "event_date" in f]
        assert logs_read and all("2024-01" in f for f in logs_read), name


def test_partial_aggregation_comes_before_the_shuffle(stored):
    plan = plan_of(attribution.spend_by_role(stored, AS_OF))
    assert plan.index("Exchange hashpartitioning") < plan.index("partial_sum") < plan.index("Generate explode")


def test_users_join_meets_grouped_rows(stored, tables):
    plan = plan_of(waste.duplicate_calls_by_user(stored, tables.users, AS_OF))
    assert re.search(r"Join(.|\n)*HashAggregate(.|\n)*ai_function_usage|Join(.|\n)*HashAggregate(.|\n)*FileScan", plan)
    top = plan_of(attribution.top_calls(stored, tables.users, AS_OF))
    assert top.index("Join") < top.index("TakeOrderedAndProject")


def test_running_totals_partition_by_block(tables):
    calls = tables.ai_function_usage.select("user_id", "start_time", "credits")
    block = F.window("start_time", "1 hour").start
    plan = plan_of(running_totals(calls, ["user_id"], "start_time", ["credits"], block))
    assert re.search(r"hashpartitioning\(user_id#\d+L?, _block#\d+", plan)


def test_budget_scans_the_log_twice_at_most(spark):
    df = QUERIES["budget_burn_account"](spark, SMALL)
    df.collect()
    final = plan_of(df).split("Initial Plan")[0]
    assert final.count("FileScan") <= 2


def test_no_limit_is_needed_for_role_checks(stored):
    assert "Limit" not in plan_of(controls.role_grant_check(stored, ["ANALYST_ROLE"]))


def test_scorer_and_grouping_run_once(spark):
    df = QUERIES["enrich_new_rows"](spark, SMALL)
    df.collect()
    final = plan_of(df).split("Initial Plan")[0]
    assert final.count("MapInPandas") == 1
    # Printed once, or not at all where only its reuse is left in the plan.
    assert final.count("partial_count(1)") <= 1
