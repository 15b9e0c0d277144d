"""Empty input, NULLs, zero divisors, gaps, ties and boundaries."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from spendlens import schema
from spendlens.functions.tags import tag_value
from spendlens.functions.text import estimate_tokens
from spendlens.functions.time import recent
from spendlens.operators import anomaly, attribution, controls, prompts, report, tracking, waste
from checks.fixtures import AS_OF
from tests.util import CALL, METERING, SQL_CALL, cr, rows, ts


@pytest.fixture(scope="module")
def users(spark):
    return spark.createDataFrame([(1, "ann"), (2, "ben")], "user_id bigint, name string")


def calls(spark, *given):
    full = [
        (f"q{i}", user, "AI_COMPLETE", "mistral-7b", cr(credits), ts(at), roles)
        for i, (user, credits, at, roles) in enumerate(given)
    ]
    return spark.createDataFrame(full, CALL)


def test_empty_input(spark, users):
    none = calls(spark)
    assert rows(tracking.spend_by_function(none, AS_OF)) == []
    assert rows(tracking.kpis(none, users, AS_OF)) == [(0, 0.0, 0.0, 0, 0.0)]
    assert rows(tracking.project_cost(none, ["x"])) == [(None, 0) + (None,) * 5]
    assert {r[1] for r in rows(tracking.project_to_rows(none))} == {None}
    assert rows(attribution.tag_coverage(spark.createDataFrame([], SQL_CALL), AS_OF)) == []
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert rows(prompts.estimate_batch(docs)) == [(0, 0, 0.0, 0.0)]
    assert rows(prompts.context_fit(docs, 10)) == [(0, 0, 0)]
    unique, mapping = prompts.dedupe_inputs(docs)
    assert rows(unique) == [] and rows(mapping) == []


def test_summary_of_empty_tables(spark, tables):
    empty = {n: tables[n].limit(0) for n in (
        "ai_sql_usage", "ai_function_usage", "search_daily_usage", "document_ai_usage",
        "metering_daily")}
    lines = rows(report.report("summary", empty, AS_OF))
    assert [(c, n, v) for c, _, n, v in lines] == [
        ("Cortex AI SQL", 0, None),
        ("Cortex AI Functions", 0, None),
        ("Cortex Search", None, None),
        ("Document AI", 0, None),
    ]
    assert rows(report.summary_kpis(empty, AS_OF)) == [(0.0, 0, 0)]


def test_unknown_report_is_one_error_row(tables):
    error = report.report("nothing", tables, AS_OF)
    (line,) = rows(error)
    assert line[0] == "ERROR" and "daily_trend" in line[1] and line[2:] == (None, None)
    assert error.schema.simpleString() == (
        "struct<category:string,detail_1:string,total_calls:bigint,total_credits:double>"
    )


def test_unknown_users_and_same_names(spark, users):
    twin = users.union(spark.createDataFrame([(3, "ann")], users.schema))
    log = calls(
        spark,
        (1, 1, "2024-01-30", None),
        (3, 2, "2024-01-30", None),
        (9, 4, "2024-01-30", None),
        (None, 8, "2024-01-30", None),
    )
    by_user = {r[0]: (r[1], r[2]) for r in rows(attribution.spend_by_user(log, twin, AS_OF))}
    assert by_user == {"ann": (2, 3.0), None: (2, 12.0)}
    filtered = tracking.kpis(log, twin, AS_OF, user_like="AN").first()
    assert (filtered.total_queries, filtered.unique_users) == (2, 1)


def test_null_and_empty_roles(spark):
    log = calls(
        spark,
        (1, 1, "2024-01-30", None),
        (1, 1, "2024-01-30", []),
        (1, 1, "2024-01-30", ["A", "B"]),
        (1, 1, "2024-01-30", ["C", None]),
    )
    by_role = rows(attribution.spend_by_role(log, AS_OF))
    assert sorted(r[0] or "" for r in by_role) == ["", "A", "B", "C"]
    flagged = controls.role_grant_check(log, ["A"])
    assert sorted(r.query_id for r in flagged.collect()) == ["q0", "q1", "q3"]


def test_tags(spark):
    tags = spark.createDataFrame(
        [
            ("team=a,project=p,env=dev",),
            ("project=p, team = b ",),
            ("team=a,team=c",),
            ("team=",),
            ("",),
            (None,),
            ("ateam=x",),
        ],
        "query_tag string",
    )
    values = [r[0] for r in tags.select(tag_value(F.col("query_tag"), "team")).collect()]
    assert values == ["a", "b", "a", None, None, None, None]
    missing = {r.query_tag: r.missing_keys for r in controls.tag_format_check(tags).collect()}
    assert "team=a,project=p,env=dev" not in missing
    assert missing["team=a,team=c"] == "project,env"
    assert missing[None] == "team,project,env"


@pytest.mark.parametrize(
    ("tagged", "grade"), [(90, "good"), (89.95, "good"), (89.94, "warn"), (50, "warn"), (49.9, "bad"), (0, "bad")]
)
def test_coverage_grades(spark, tagged, grade):
    usage = spark.createDataFrame(
        [
            ("a", 1, "m", "f", 1, cr(tagged), "team=a", ts("2024-01-30")),
            ("b", 1, "m", "f", 1, cr(100 - tagged), "", ts("2024-01-30")),
        ],
        SQL_CALL,
    )
    assert {r.grade for r in attribution.tag_coverage(usage, AS_OF).collect()} == {grade}


def test_zero_divisors(spark):
    monitors = spark.createDataFrame(
        [("m", cr(0), cr(5), cr(4), cr(1))],
        "name string, credit_quota decimal(18,9), credits_used decimal(18,9), "
        "credits_used_compute decimal(18,9), credits_used_cloud_services decimal(18,9)",
    )
    assert tracking.quota_status(monitors, "m").first().pct_used is None
    usage = spark.createDataFrame(
        [("a", 1, "m", "f", 0, cr(1), None, ts("2024-01-30"))], SQL_CALL
    )
    tier = waste.model_tiers(usage, AS_OF).first()
    assert (tier.credits_per_1m_tokens, tier.cost_tier) == (None, "Premium")


def test_tier_uses_the_exact_rate(spark):
    usage = spark.createDataFrame(
        [("a", 1, "m", "f", 1_000_000, cr("1.999"), None, ts("2024-01-30"))], SQL_CALL
    )
    tier = waste.model_tiers(usage, AS_OF).first()
    assert (tier.credits_per_1m_tokens, tier.cost_tier) == (2.0, "Budget")


def test_window_bounds(spark):
    log = calls(
        spark,
        (1, 1, "2024-01-24 12:00:00", None),
        (1, 1, "2024-01-24 11:59:59", None),
        (1, 1, "2024-01-31 12:00:00", None),
        (1, 1, "2024-01-31 12:00:01", None),
    )
    kept = recent(log, "start_time", "2024-01-31 12:00:00", days=7)
    assert sorted(r.query_id for r in kept.collect()) == ["q0", "q2"]


def test_date_bound_after_midnight_leaves_out_its_own_day(spark):
    days = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 1, 2),)], "d date")
    assert recent(days, "d", "2024-01-31 06:00:00", days=30).count() == 1
    assert recent(days, "d", "2024-01-31 06:00:00", days=30, whole_days=True).count() == 2
    assert recent(days, "d", "2024-01-31 00:00:00", days=30).count() == 2


def test_as_of_must_be_naive(spark):
    days = spark.createDataFrame([(date(2024, 1, 1),)], "d date")
    with pytest.raises(ValueError, match="naive"):
        recent(days, "d", "2024-01-31T00:00:00+02:00", days=1)


def test_gap_days_shift_rows_but_not_dates(spark):
    billed = [(date(2024, 1, d), "AI_SERVICES", cr(d), cr(d)) for d in range(1, 31) if d != 20]
    metering = spark.createDataFrame(billed, METERING)
    by_rows = {r.day.day: r.last_week for r in anomaly.week_over_week(metering, AS_OF).collect()}
    by_date = {
        r.day.day: r.last_week
        for r in anomaly.week_over_week_calendar(metering, AS_OF).collect()
    }
    assert by_rows[19] == by_date[19] == 12.0
    assert (by_rows[23], by_date[23]) == (15.0, 16.0)
    assert by_date[27] is None
    assert 20 not in by_date and max(by_date) == 30


def test_week_over_year_end(spark):
    usage = spark.createDataFrame(
        [
            ("a", 1, "m", "f", 10, cr(1), None, ts("2023-12-31 23:59:59")),
            ("b", 1, "m", "f", 30, cr(1), None, ts("2024-01-01 00:00:00")),
            ("c", 1, "m", "f", 50, cr(1), None, ts("2024-01-07 12:00:00")),
        ],
        SQL_CALL,
    )
    weeks = {str(r.week)[:10]: r.avg_tokens_per_call for r in waste.prompt_trend(usage, AS_OF).collect()}
    assert weeks == {"2023-12-25": 10.0, "2024-01-01": 40.0}


def test_rounded_multiplier_decides(spark, users):
    weeks = ["2024-01-01", "2024-01-08"]
    log = calls(
        spark,
        (1, 1, weeks[0], None),
        (1, "3.04", weeks[1], None),
        (2, 1, weeks[0], None),
        (2, "3.05", weeks[1], None),
    )
    assert [r[0] for r in rows(anomaly.user_weekly_spike(log, users, AS_OF))] == ["ben"]


def test_ties_at_a_cut_are_decided_by_query_id(spark, users):
    log = calls(spark, *[(1, 1, "2024-01-30", None)] * 5)
    top = attribution.top_calls(log, users, AS_OF, n=2)
    assert [r.query_id for r in top.collect()] == ["q0", "q1"]


def test_nulls_sort_first_in_a_descending_cut(spark, users):
    log = calls(spark, (1, 5, "2024-01-30", None)).union(
        spark.createDataFrame(
            [("qn", 1, "AI_COMPLETE", None, None, ts("2024-01-30"), None)], CALL
        )
    )
    assert attribution.top_calls(log, users, AS_OF, n=1).first().query_id == "qn"
    assert attribution.top_calls(log, users, AS_OF, n=1, positive=True).first().query_id == "q0"


def test_allowlist_modes(spark):
    log = calls(spark, (1, 1, "2024-01-30", None))
    assert controls.model_allowlist(log, "ALL").count() == 0
    assert controls.model_allowlist(log, " none ").count() == 1
    assert controls.model_allowlist(log, ["mistral-7b"]).count() == 0
    assert controls.model_allowlist(log, "llama3.1-8b, other").count() == 1


def test_token_estimates(spark):
    texts = spark.createDataFrame([("",), ("abcd",), ("abcde",), (None,)], "t string")
    by_chars = [r[0] for r in texts.select(estimate_tokens(F.col("t"))).collect()]
    by_words = [r[0] for r in texts.select(estimate_tokens(F.col("t"), "words")).collect()]
    assert by_chars == [0, 1, 2, None]
    assert by_words == [0, 2, 2, None]
    with pytest.raises(ValueError):
        estimate_tokens(F.col("t"), "letters")


def test_enrich_keeps_oversized_and_null_rows(spark):
    docs = spark.createDataFrame(
        [(1, "short"), (2, "short"), (3, "x" * 100), (4, None), (5, "done")],
        "doc_id bigint, text string",
    )
    ledger = spark.createDataFrame([(5,)], "doc_id bigint")

    def length(texts):
        return texts.str.len().to_frame("n").astype("int64")

    labelled = prompts.enrich(docs, length, "n bigint", max_tokens=10, ledger=ledger)
    assert sorted(rows(labelled)) == [(1, 5), (2, 5), (3, None), (4, None)]


def test_cost_index_without_baseline(spark):
    costs = spark.createDataFrame(
        [("a", cr(1)), ("b", cr(25)), ("c", cr(0))], "model string, credits decimal(18,9)"
    )
    index = {r.model: r.cost_index for r in prompts.cost_index(costs, "a").collect()}
    assert index == {"a": 1.0, "b": 25.0, "c": None}
    assert {r.cost_index for r in prompts.cost_index(costs, "zzz").collect()} == {None}


def test_filler_phrases(spark):
    docs = spark.createDataFrame(
        [(1, "I need you to be quick. PLEASE MAKE SURE TO read."), (2, "Classify:")],
        "doc_id bigint, text string",
    )
    ((key, phrases, tokens, saved),) = rows(prompts.prompt_filler_scan(docs))
    assert (key, phrases, tokens, saved) == (1, 2, 13, 8)


def test_conform(spark):
    raw = spark.createDataFrame([("1", "ann", 0)], "USER_ID string, Name string, extra int")
    assert rows(schema.conform(raw, "users")) == [(1, "ann")]
    with pytest.raises(ValueError, match="missing columns name"):
        schema.conform(raw.drop("Name"), "users")
