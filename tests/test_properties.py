"""Relations that must hold between reports, whatever the data."""

import pytest
from pyspark.sql import functions as F

from spendlens.operators import anomaly, attribution, report, tracking, waste
from spendlens.plans.rollup import hourly_rollup
from checks.fixtures import AS_OF
from tests.util import rows


def _sum(df, column):
    return df.agg(F.sum(F.col(column).cast("decimal(28,9)"))).first()[0]


def test_hours_days_and_total_agree(tables):
    calls = tables.ai_function_usage
    by_day = tracking.daily_function_trend(calls, AS_OF, days=30)
    hours = hourly_rollup(calls, "start_time", "credits")
    total = calls.agg(F.sum("credits")).first()[0]
    assert _sum(by_day, "daily_credits") == total
    assert _sum(hours, "credits_sum") == total


def test_tagged_and_untagged_make_the_total(tables):
    usage = tables.ai_sql_usage
    coverage = attribution.tag_coverage(usage, AS_OF, days=90)
    assert _sum(coverage, "credits") == usage.agg(F.sum("token_credits")).first()[0]
    assert _sum(coverage, "calls") == usage.count()


def test_split_roles_and_models_make_the_total(tables):
    calls = tables.ai_function_usage.where("role_names IS NOT NULL")
    total = float(calls.agg(F.sum("credits")).first()[0])
    whole = attribution.spend_by_role(calls, AS_OF, days=60)
    parts = attribution.spend_by_role(calls, AS_OF, days=60, split=True)
    assert float(_sum(parts, "total_credits")) == pytest.approx(total, abs=1e-6)
    assert float(_sum(whole, "total_credits")) > total
    usage = tables.assistant_cli_usage
    spent = float(usage.agg(F.sum("total_credits")).first()[0])
    models = tracking.assistant_by_user_model(usage, AS_OF, days=60, split=True)
    assert float(_sum(models, "total_credits")) == pytest.approx(spent, abs=1e-6)


def test_longer_window_never_lowers_spend(tables):
    spends = [
        tracking.kpis(tables.ai_function_usage, tables.users, AS_OF, days=d).first()
        for d in (1, 7, 30)
    ]
    totals = [s.total_credits for s in spends]
    assert totals == sorted(totals)


def test_free_calls_change_counts_only(tables):
    calls = tables.ai_function_usage
    free = calls.withColumn("credits", F.lit(0).cast("decimal(18,9)"))
    before = {r.function_name: r for r in tracking.spend_by_function(calls, AS_OF).collect()}
    after = tracking.spend_by_function(calls.unionByName(free), AS_OF).collect()
    for row in after:
        assert row.total_ai_credits == before[row.function_name].total_ai_credits
        assert row.call_count == 2 * before[row.function_name].call_count


FUNCTION_REPORTS = {
    "spend_by_function": lambda c, u: tracking.spend_by_function(c, AS_OF),
    "model_cost_comparison": lambda c, u: tracking.model_cost_comparison(c, AS_OF, hours=72),
    "hourly_spend": lambda c, u: tracking.hourly_spend(c, AS_OF, days=3),
    "hourly_trend": lambda c, u: tracking.hourly_trend(c, AS_OF, users=u, user_like="7"),
    "daily_function_trend": lambda c, u: tracking.daily_function_trend(c, AS_OF),
    "kpis": lambda c, u: tracking.kpis(c, u, AS_OF),
    "top_functions": lambda c, u: tracking.top_functions(c, AS_OF, n=3),
    "model_panel": lambda c, u: tracking.model_panel(c, AS_OF),
    "spend_by_user": lambda c, u: attribution.spend_by_user(c, u, AS_OF),
    "completion_audit": lambda c, u: waste.completion_audit(c, AS_OF),
    "duplicates": lambda c, u: waste.duplicate_calls_by_user(c, u, AS_OF, more_than=1),
    "rightsizing": lambda c, u: waste.rightsizing_savings(c, AS_OF),
    "user_weekly_spike": lambda c, u: anomaly.user_weekly_spike(c, u, AS_OF, over=1),
}
SQL_REPORTS = {
    "top_spenders": lambda c, u: attribution.top_spenders(c, u, AS_OF),
    "rate_per_million": lambda c, u: waste.rate_per_million(c, AS_OF),
    "model_tiers": lambda c, u: waste.model_tiers(c, AS_OF),
    "prompt_trend": lambda c, u: waste.prompt_trend(c, AS_OF),
    "call_cost_gap": lambda c, u: waste.call_cost_gap(c, AS_OF),
    "heavy_call_users": lambda c, u: waste.heavy_call_users(c, u, AS_OF),
    "usage_by_hour_of_day": lambda c, u: waste.usage_by_hour_of_day(c, u, AS_OF),
}


@pytest.mark.parametrize("name", sorted(FUNCTION_REPORTS))
def test_function_rollup_gives_the_same(tables, name):
    calls, users = tables.ai_function_usage, tables.users
    rollup = hourly_rollup(calls, "start_time", "credits")
    build = FUNCTION_REPORTS[name]
    assert rows(build(rollup, users)) == rows(build(calls, users))


@pytest.mark.parametrize("name", sorted(SQL_REPORTS))
def test_sql_rollup_gives_the_same(tables, name):
    usage, users = tables.ai_sql_usage, tables.users
    rollup = hourly_rollup(usage, "usage_time", "token_credits")
    build = SQL_REPORTS[name]
    assert rows(build(rollup, users)) == rows(build(usage, users))


def test_report_reads_rollups(tables):
    rolled = {
        name: tables[name]
        for name in ("search_daily_usage", "document_ai_usage", "metering_daily")
    }
    rolled["ai_sql_usage"] = hourly_rollup(tables.ai_sql_usage, "usage_time", "token_credits")
    rolled["ai_function_usage"] = hourly_rollup(
        tables.ai_function_usage, "start_time", "credits"
    )
    for kind in report.REPORTS:
        assert sorted(map(repr, rows(report.report(kind, rolled, AS_OF)))) == sorted(
            map(repr, rows(report.report(kind, tables, AS_OF)))
        )


def test_rollup_needs_a_whole_hour(tables):
    rollup = hourly_rollup(tables.ai_function_usage, "start_time", "credits")
    with pytest.raises(ValueError, match="on the hour"):
        tracking.spend_by_function(rollup, "2024-01-31 00:30:00")
    with pytest.raises(ValueError, match="on the hour"):
        tracking.model_cost_comparison(rollup, AS_OF, hours=1.5)
