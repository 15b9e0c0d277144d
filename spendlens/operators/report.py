"""Report dispatch: five reports with one schema.

Every report returns (category STRING, detail_1 STRING, total_calls BIGINT,
total_credits DOUBLE).
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlens.functions.money import total
from spendlens.functions.time import recent
from spendlens.operators.attribution import AI_SERVICE_TYPES
from spendlens.plans.rollup import FUNCTION_LOG, SQL_LOG, Usage

# Report names.
REPORTS = (
    "summary",
    "cortex_aisql_by_model",
    "ai_functions_by_model",
    "cortex_search_by_service",
    "daily_trend",
)

# Categories of the summary report.
SQL_CATEGORY = "Cortex AI SQL"
FUNCTIONS_CATEGORY = "Cortex AI Functions"
SEARCH_CATEGORY = "Cortex Search"
DOCUMENT_CATEGORY = "Document AI"
METERING_CATEGORY = "AI Metering"

#: Usage tables by name; anything with ``tables[name]``.
Tables = Mapping[str, DataFrame]



def _line(category: Column, detail: Column | None, calls: Column | None) -> list[Column]:
    nothing = F.lit(None)
    return [
        category.cast("string").alias("category"),
        (nothing if detail is None else detail).cast("string").alias("detail_1"),
        (nothing if calls is None else calls).cast("bigint").alias("total_calls"),
        F.col("c").alias("total_credits"),
    ]


def _in_double(df: DataFrame) -> DataFrame:
    return df.withColumn("total_credits", F.col("total_credits").cast("double"))


def _ai_metering(tables: Tables, as_of, days) -> DataFrame:
    return recent(tables["metering_daily"], "usage_date", as_of, days=days).where(
        F.col("service_type").isin(*AI_SERVICE_TYPES)
    )


def _summary(tables: Tables, as_of, days) -> DataFrame:
    """The summary with credits still DECIMAL."""
    sql = Usage.of(tables["ai_sql_usage"], SQL_LOG).window(as_of, days=days)
    functions = Usage.of(tables["ai_function_usage"], FUNCTION_LOG).window(as_of, days=days)
    search = recent(tables["search_daily_usage"], "usage_date", as_of, days=days)
    document = recent(tables["document_ai_usage"], "start_time", as_of, days=days)
    metering = _ai_metering(tables, as_of, days).groupBy("service_type")
    calls = F.coalesce(F.col("n"), F.lit(0))
    parts = [
        sql.df.agg(sql.calls().alias("n"), sql.credits().alias("c")).select(
            _line(F.lit(SQL_CATEGORY), None, calls)
        ),
        functions.df.agg(functions.calls().alias("n"), functions.credits().alias("c")).select(
            _line(F.lit(FUNCTIONS_CATEGORY), None, calls)
        ),
        search.agg(total("credits").alias("c")).select(
            _line(F.lit(SEARCH_CATEGORY), None, None)
        ),
        document.agg(F.count(F.lit(1)).alias("n"), total("credits_used").alias("c")).select(
            _line(F.lit(DOCUMENT_CATEGORY), None, calls)
        ),
        metering.agg(total("credits_billed").alias("c")).select(
            _line(F.lit(METERING_CATEGORY), F.col("service_type"), None)
        ),
    ]
    return reduce(DataFrame.unionByName, parts)


def summary(tables: Tables, as_of, days=30) -> DataFrame:
    """Calls and credits per usage log, and metered credits per service type."""
    return _in_double(_summary(tables, as_of, days))


def sql_by_model(tables: Tables, as_of, days=30) -> DataFrame:
    log = Usage.of(tables["ai_sql_usage"], SQL_LOG).window(as_of, days=days)
    grouped = log.df.groupBy("model_name", "function_name").agg(
        log.calls().alias("n"), log.credits().alias("c")
    )
    return _in_double(
        grouped.select(_line(F.col("model_name"), F.col("function_name"), F.col("n")))
    ).orderBy(F.desc_nulls_first("total_credits"), "category", "detail_1")


def functions_by_model(tables: Tables, as_of, days=30) -> DataFrame:
    log = Usage.of(tables["ai_function_usage"], FUNCTION_LOG).window(as_of, days=days)
    grouped = log.df.groupBy("function_name", "model_name").agg(
        log.calls().alias("n"), log.credits().alias("c")
    )
    return _in_double(
        grouped.select(_line(F.col("function_name"), F.col("model_name"), F.col("n")))
    ).orderBy(F.desc_nulls_first("total_credits"), "category", "detail_1")


def search_by_service(tables: Tables, as_of, days=30) -> DataFrame:
    place = F.concat("database_name", F.lit("."), "schema_name")
    grouped = (
        recent(tables["search_daily_usage"], "usage_date", as_of, days=days)
        .groupBy("service_name", "database_name", "schema_name")
        .agg(total("credits").alias("c"))
    )
    return _in_double(grouped.select(_line(F.col("service_name"), place, None))).orderBy(
        F.desc_nulls_first("total_credits"), "category", "detail_1"
    )


def daily_trend(tables: Tables, as_of, days=30) -> DataFrame:
    grouped = (
        _ai_metering(tables, as_of, days)
        .groupBy("usage_date")
        .agg(total("credits_billed").alias("c"))
    )
    return _in_double(grouped.select(_line(F.col("usage_date"), None, None))).orderBy(
        "category"
    )


def _invalid(tables: Tables) -> DataFrame:
    spark = tables["metering_daily"].sparkSession
    message = "Invalid report_type. Use: " + ", ".join(REPORTS)
    line = spark.range(1).select(F.lit(None).cast("decimal(28,9)").alias("c"))
    return _in_double(line.select(_line(F.lit("ERROR"), F.lit(message), None)))


def report(kind: str, tables: Tables, as_of, days=30) -> DataFrame:
    """Run the named report; an unknown name gives one ERROR row."""
    builders = dict(
        zip(
            REPORTS,
            (summary, sql_by_model, functions_by_model, search_by_service, daily_trend),
            strict=True,
        )
    )
    build = builders.get(kind)
    return _invalid(tables) if build is None else build(tables, as_of, days)


def summary_kpis(tables: Tables, as_of, days=30, include_metering=True) -> DataFrame:
    """Total credits, total calls and lines with spend, over the summary.

    Metering bills the same calls the logs record, so with it the total counts
    spend twice; ``include_metering=False`` counts it once.
    """
    lines = _summary(tables, as_of, days)
    if not include_metering:
        lines = lines.where(F.col("category") != METERING_CATEGORY)
    return lines.agg(
        F.coalesce(F.sum("total_credits").cast("double"), F.lit(0.0)).alias("total_credits"),
        F.coalesce(F.sum("total_calls"), F.lit(0)).alias("total_calls"),
        F.count(F.when(F.col("total_credits") > 0, 1)).alias("active_services"),
    )
