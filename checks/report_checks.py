"""Queries and oracles of the report dispatch."""

from checks.catalog import query
from checks.sql import AI_TYPES, credits, last, last_dates
from spendlens.operators import report
from checks.fixtures import AS_OF


def _grouped(category, detail, calls, credit_col, view, condition, keys):
    group = f"GROUP BY {keys}" if keys else ""
    return f"""
SELECT CAST({category} AS VARCHAR) AS category, CAST({detail} AS VARCHAR) AS detail_1,
  CAST({calls} AS BIGINT) AS total_calls, {credits(credit_col)} AS total_credits
FROM {view} WHERE {condition} {group}"""


METERING = f"service_type IN {AI_TYPES} AND {last_dates('usage_date', 30)}"

SUMMARY = " UNION ALL ".join(
    [
        _grouped("'Cortex AI SQL'", "NULL", "count(*)", "token_credits", "ai_sql_usage",
                 last("usage_time", 30), ""),
        _grouped("'Cortex AI Functions'", "NULL", "count(*)", "credits", "ai_function_usage",
                 last("start_time", 30), ""),
        _grouped("'Cortex Search'", "NULL", "NULL", "credits", "search_daily_usage",
                 last_dates("usage_date", 30), ""),
        _grouped("'Document AI'", "NULL", "count(*)", "credits_used", "document_ai_usage",
                 last("start_time", 30), ""),
        _grouped("'AI Metering'", "service_type", "NULL", "credits_billed", "metering_daily",
                 METERING, "service_type"),
    ]
)

BY_KIND = {
    "summary": SUMMARY,
    "cortex_aisql_by_model": _grouped(
        "model_name", "function_name", "count(*)", "token_credits", "ai_sql_usage",
        last("usage_time", 30), "model_name, function_name",
    ),
    "ai_functions_by_model": _grouped(
        "function_name", "model_name", "count(*)", "credits", "ai_function_usage",
        last("start_time", 30), "function_name, model_name",
    ),
    "cortex_search_by_service": _grouped(
        "service_name", "database_name || '.' || schema_name", "NULL", "credits",
        "search_daily_usage", last_dates("usage_date", 30),
        "service_name, database_name, schema_name",
    ),
    "daily_trend": _grouped(
        "usage_date", "NULL", "NULL", "credits_billed", "metering_daily", METERING, "usage_date"
    ),
}


def _register(kind):
    @query(f"report_{kind}", BY_KIND[kind])
    def _(t):
        return report.report(kind, t, AS_OF)


for _kind in BY_KIND:
    _register(_kind)


@query(
    "report_unknown_and_daily",
    BY_KIND["daily_trend"]
    + """ UNION ALL SELECT 'ERROR', 'Invalid report_type. Use: summary, cortex_aisql_by_model, ai_functions_by_model, cortex_search_by_service, daily_trend', NULL, NULL""",
)
def _(t):
    """An unknown name gives one ERROR row in the shape of the reports."""
    return report.report("daily_trend", t, AS_OF).unionByName(report.report("nonsense", t, AS_OF))


def _kpis(condition):
    """Sums whole nano-credits, so that the total does not depend on the order."""
    return f"""
SELECT CAST(sum(CAST(round(total_credits * 1e9) AS BIGINT)) AS DOUBLE) / 1e9 AS total_credits,
  CAST(coalesce(sum(total_calls), 0) AS BIGINT) AS total_calls,
  count(CASE WHEN total_credits > 0 THEN 1 END) AS active_services
FROM ({SUMMARY}) lines {condition}"""


@query("summary_kpis", _kpis(""))
def _(t):
    return report.summary_kpis(t, AS_OF)


@query("summary_kpis_without_metering", _kpis("WHERE category <> 'AI Metering'"))
def _(t):
    return report.summary_kpis(t, AS_OF, include_metering=False)
