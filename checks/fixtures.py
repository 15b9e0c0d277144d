"""Usage tables derived from the sample data set, for tests and benchmarks.

The texts are SQL both Spark and DuckDB can run once the few dialect words are
swapped; the oracle queries use the same definitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2024-01-31 00:00:00"

_ASSISTANT = """
SELECT event_id AS request_id, user_id, concat('user_', CAST(user_id AS STRING)) AS user_name,
  CASE WHEN user_id % 2 = 0 THEN 'claude-4-sonnet' ELSE 'llama3.1-70b' END AS model_name,
  100 + event_id % 900 AS input_tokens, 10 + event_id % 90 AS output_tokens,
  110 + event_id % 900 + event_id % 90 AS total_tokens,
  CAST((100 + event_id % 900) * 0.0000015 + (10 + event_id % 90) * 0.0000075 AS DECIMAL(18,9)) AS total_credits,
  ts AS event_timestamp
FROM events WHERE event_type IN ({types})"""

_SQL_RATE = (
    "(CASE l_partkey % 4 WHEN 0 THEN 0.00000012 WHEN 1 THEN 0.00000121 "
    "WHEN 2 THEN 0.00000220 ELSE 0.00000450 END)"
)

#: When a call of the SQL log happened.
USAGE_TIME = """TIMESTAMP_NTZ '2024-01-31 00:00:00'
    - CAST((l_orderkey * 7919 + l_partkey * 104729 + l_linenumber * 31337) % 5529600 AS INT) * INTERVAL '1' SECOND"""

#: View name -> (source table, SQL).
VIEWS: dict[str, tuple[str, str]] = {
    "users": (
        "customer",
        "SELECT c_custkey AS user_id, c_name AS name FROM customer WHERE c_custkey % 19 <> 0",
    ),
    "ai_function_usage": (
        "events",
        """
SELECT concat('q', CAST(event_id AS STRING)) AS query_id, user_id,
  CASE event_id % 7 WHEN 0 THEN 'COMPLETE' WHEN 1 THEN 'AI_COMPLETE' WHEN 2 THEN 'AI_SENTIMENT'
    WHEN 3 THEN 'AI_CLASSIFY' WHEN 4 THEN 'AI_TRANSLATE' WHEN 5 THEN 'AI_FILTER' ELSE 'AI_EXTRACT' END AS function_name,
  CASE WHEN event_id % 7 > 1 THEN NULL WHEN user_id % 3 = 0 THEN 'mistral-7b'
    WHEN user_id % 3 = 1 THEN 'llama3.1-70b' ELSE 'claude-4-sonnet' END AS model_name,
  CAST(CAST(round(value * 100) AS BIGINT) * 0.000013 AS DECIMAL(18,9)) AS credits,
  ts AS start_time,
  CASE event_type WHEN 'click' THEN array('ANALYST_ROLE','DEV_ROLE') WHEN 'view' THEN array('PROD_PIPELINE_ROLE')
    WHEN 'signup' THEN array('DEV_ROLE')
    WHEN 'purchase' THEN array('DATA_SCIENCE_ROLE','PROD_PIPELINE_ROLE','ANALYST_ROLE') ELSE NULL END AS role_names
FROM events""",
    ),
    "ai_sql_usage": (
        "lineitem",
        f"""
SELECT concat('s', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING), '-', CAST(l_partkey AS STRING), '-',
    CAST(l_suppkey AS STRING), '-', CAST(CAST(l_quantity AS BIGINT) AS STRING)) AS query_id, l_suppkey AS user_id,
  CASE l_partkey % 4 WHEN 0 THEN 'mistral-7b' WHEN 1 THEN 'llama3.1-70b' WHEN 2 THEN 'mistral-large2'
    ELSE 'claude-4-sonnet' END AS model_name,
  CASE l_linenumber % 4 WHEN 0 THEN 'AI_COMPLETE' WHEN 1 THEN 'AI_CLASSIFY' WHEN 2 THEN 'AI_AGG'
    ELSE 'AI_FILTER' END AS function_name,
  CAST(l_quantity AS BIGINT) * 1100 + l_partkey % 977 AS tokens,
  CAST((CAST(l_quantity AS BIGINT) * 1100 + l_partkey % 977) * {_SQL_RATE} AS DECIMAL(18,9)) AS token_credits,
  CAST(l_quantity AS BIGINT) * 1100 - (l_partkey % 97 + 1) AS input_tokens, l_partkey % 977 AS output_tokens,
  l_partkey % 97 + 1 AS reasoning_tokens,
  CAST((CAST(l_quantity AS BIGINT) * 1100 - (l_partkey % 97 + 1)) * {_SQL_RATE} AS DECIMAL(18,9)) AS input_credits,
  CAST((l_partkey % 977) * {_SQL_RATE} AS DECIMAL(18,9)) AS output_credits,
  CAST((l_partkey % 97 + 1) * {_SQL_RATE} AS DECIMAL(18,9)) AS reasoning_credits,
  CASE WHEN l_returnflag = 'A' THEN NULL WHEN l_returnflag = 'N' THEN ''
    ELSE concat('team=t', CAST(l_suppkey % 5 AS STRING), ',project=p', CAST(l_partkey % 9 AS STRING), ',env=',
      CASE WHEN l_linestatus = 'F' THEN 'prod' ELSE 'dev' END) END AS query_tag,
  {USAGE_TIME} AS usage_time
FROM lineitem""",
    ),
    "search_daily_usage": (
        "events",
        """
SELECT concat('svc_', CAST(user_id % 20 AS STRING)) AS service_name, concat('DB', CAST(user_id % 3 AS STRING)) AS database_name,
  concat('SCH', CAST(user_id % 2 AS STRING)) AS schema_name,
  CASE WHEN event_type IN ('signup','error') OR user_id % 5 = 0 THEN 'INDEXING'
    WHEN user_id % 5 = 1 AND CAST(ts AS DATE) > DATE '2024-01-12' THEN 'INDEXING'
    WHEN event_type = 'view' THEN 'SERVING' ELSE 'QUERY' END AS consumption_type,
  CAST(CAST(round(value * 100) AS BIGINT) * 0.00002 AS DECIMAL(18,9)) AS credits,
  CAST(round(value * 100) AS BIGINT) * 7 AS tokens, CAST(ts AS DATE) AS usage_date
FROM events""",
    ),
    "document_ai_usage": (
        "documents",
        """
SELECT doc_id, concat('docmodel-', lang) AS model_name, CAST(n_chars * 0.0000031 AS DECIMAL(18,9)) AS credits_used,
  TIMESTAMP_NTZ '2024-01-31 00:00:00' - CAST((doc_id * 7919) % 2592000 AS INT) * INTERVAL '1' SECOND AS start_time
FROM documents""",
    ),
    "metering_daily": (
        "orders",
        """
SELECT CAST(o_orderdate AS DATE) + 8217 AS usage_date,
  CASE o_custkey % 7 WHEN 0 THEN 'AI_SERVICES' WHEN 1 THEN 'CORTEX_AGENTS' WHEN 2 THEN 'CORTEX_CODE_CLI'
    WHEN 3 THEN 'CORTEX_CODE_SNOWSIGHT' WHEN 4 THEN 'SNOWFLAKE_INTELLIGENCE' WHEN 5 THEN 'WAREHOUSE_METERING'
    ELSE 'AI_SERVICES' END AS service_type,
  CAST(CAST(round(o_totalprice * 100) AS BIGINT) * 0.0000009 AS DECIMAL(18,9)) AS credits_used,
  CAST(CAST(round(o_totalprice * 100) AS BIGINT) * 0.0000008 AS DECIMAL(18,9)) AS credits_billed
FROM orders""",
    ),
    "assistant_cli_usage": ("events", _ASSISTANT.format(types="'click','view'")),
    "assistant_web_usage": ("events", _ASSISTANT.format(types="'purchase'")),
    "query_history": (
        "orders",
        """
SELECT concat('h', CAST(o_orderkey AS STRING)) AS query_id, concat('user_', CAST(o_custkey % 50 AS STRING)) AS user_name,
  CASE o_orderkey % 6 WHEN 0 THEN 'SELECT AI_COMPLETE(x) FROM t' WHEN 1 THEN 'select ai_sentiment(c) from f'
    WHEN 2 THEN 'SELECT SNOWFLAKE.CORTEX.SENTIMENT(c) FROM f' WHEN 3 THEN 'INSERT INTO t VALUES (1)'
    WHEN 4 THEN 'SELECT AI_FILTER(concat(a, b)) FROM t' ELSE 'SELECT count(*) FROM orders' END AS query_text,
  CAST(round(o_totalprice) AS BIGINT) AS total_elapsed_time,
  CAST(CAST(round(o_totalprice * 100) AS BIGINT) * 0.0000000001 AS DECIMAL(18,9)) AS credits_used_cloud_services,
  TIMESTAMP_NTZ '2024-01-31 00:00:00' - CAST((o_orderkey * 7919) % 172800 AS INT) * INTERVAL '1' SECOND AS start_time
FROM orders""",
    ),
    "quota_monitors": (
        "nation",
        """
SELECT concat('MONITOR_', n_name) AS name,
  CAST(CASE WHEN n_nationkey = 7 THEN 0 ELSE 50 END AS DECIMAL(18,9)) AS credit_quota,
  CAST(n_nationkey * 2.25 AS DECIMAL(18,9)) AS credits_used, CAST(n_nationkey * 2.0 AS DECIMAL(18,9)) AS credits_used_compute,
  CAST(n_nationkey * 0.25 AS DECIMAL(18,9)) AS credits_used_cloud_services
FROM nation""",
    ),
    "budget_history": (
        "orders",
        """
SELECT concat('BUDGET_', CAST(o_orderkey AS STRING)) AS budget_name,
  CAST(500 + o_custkey % 7 * 100 AS DECIMAL(18,9)) AS spending_limit,
  CAST(o_custkey % 11 * 50 AS DECIMAL(18,9)) AS credit_quota,
  TIMESTAMP_NTZ '2024-01-31 00:00:00' - CAST((o_orderkey * 7919) % 5184000 AS INT) * INTERVAL '1' SECOND AS start_time
FROM orders""",
    ),
}


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived usage table, or one of the sample tables as it is."""
    if name not in VIEWS:
        return source(spark, sf_dir, name)
    base, sql = VIEWS[name]
    df = spark.sql(
        sql.replace(f"FROM {base}", "FROM {base}"), base=source(spark, sf_dir, base)
    )
    if name == "ai_sql_usage":
        df = _packed(df)
    if name.startswith("assistant_"):
        df = _with_model_map(df)
    return df


def _packed(df: DataFrame) -> DataFrame:
    parts = ("input", "output", "reasoning")
    flat = [f"{p}_{kind}" for kind in ("tokens", "credits") for p in parts]
    return df.withColumns(
        {
            "tokens_granular": F.struct(*[F.col(f"{p}_tokens").alias(p) for p in parts]),
            "token_credits_granular": F.struct(
                *[F.col(f"{p}_credits").alias(p) for p in parts]
            ),
        }
    ).drop(*flat)


def _with_model_map(df: DataFrame) -> DataFrame:
    """Token map per model; every fifth request also used a second model."""
    main = F.create_map(
        "model_name",
        F.struct(F.col("input_tokens").alias("input"), F.col("output_tokens").alias("output")),
    )
    second = F.create_map(
        F.lit("mistral-7b"),
        F.struct(
            (F.col("input_tokens") % 50).alias("input"),
            (F.col("output_tokens") % 20).alias("output"),
        ),
    )
    both = F.when(F.col("request_id") % 5 == 0, F.map_concat(main, second)).otherwise(main)
    return df.withColumn("tokens_granular", both).drop(
        "model_name", "input_tokens", "output_tokens"
    )


def usage_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All derived usage tables by name."""
    return {name: table(spark, sf_dir, name) for name in VIEWS}
