"""Canonical input schemas and the check that an input fits one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlens.functions.time import EVENT_DATE

CREDITS = T.DecimalType(18, 9)

_TOKEN_SPLIT = T.StructType(
    [
        T.StructField("input", T.LongType()),
        T.StructField("output", T.LongType()),
        T.StructField("reasoning", T.LongType()),
    ]
)
_CREDIT_SPLIT = T.StructType(
    [
        T.StructField("input", CREDITS),
        T.StructField("output", CREDITS),
        T.StructField("reasoning", CREDITS),
    ]
)
_MODEL_TOKENS = T.MapType(
    T.StringType(),
    T.StructType(
        [T.StructField("input", T.LongType()), T.StructField("output", T.LongType())]
    ),
)


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


_ASSISTANT = _table(
    request_id=T.LongType(),
    user_id=T.LongType(),
    user_name=T.StringType(),
    event_timestamp=T.TimestampType(),
    total_tokens=T.LongType(),
    total_credits=CREDITS,
    tokens_granular=_MODEL_TOKENS,
)

TABLES: dict[str, T.StructType] = {
    "ai_function_usage": _table(
        query_id=T.StringType(),
        user_id=T.LongType(),
        function_name=T.StringType(),
        model_name=T.StringType(),
        credits=CREDITS,
        start_time=T.TimestampType(),
        role_names=T.ArrayType(T.StringType()),
    ),
    "ai_sql_usage": _table(
        query_id=T.StringType(),
        user_id=T.LongType(),
        model_name=T.StringType(),
        function_name=T.StringType(),
        tokens=T.LongType(),
        token_credits=CREDITS,
        tokens_granular=_TOKEN_SPLIT,
        token_credits_granular=_CREDIT_SPLIT,
        query_tag=T.StringType(),
        usage_time=T.TimestampType(),
    ),
    "search_daily_usage": _table(
        service_name=T.StringType(),
        database_name=T.StringType(),
        schema_name=T.StringType(),
        consumption_type=T.StringType(),
        credits=CREDITS,
        tokens=T.LongType(),
        usage_date=T.DateType(),
    ),
    "document_ai_usage": _table(
        model_name=T.StringType(), credits_used=CREDITS, start_time=T.TimestampType()
    ),
    "metering_daily": _table(
        usage_date=T.DateType(),
        service_type=T.StringType(),
        credits_used=CREDITS,
        credits_billed=CREDITS,
    ),
    "assistant_cli_usage": _ASSISTANT,
    "assistant_web_usage": _ASSISTANT,
    "query_history": _table(
        query_id=T.StringType(),
        query_text=T.StringType(),
        user_name=T.StringType(),
        start_time=T.TimestampType(),
        total_elapsed_time=T.LongType(),
        credits_used_cloud_services=CREDITS,
    ),
    "quota_monitors": _table(
        name=T.StringType(),
        credit_quota=CREDITS,
        credits_used=CREDITS,
        credits_used_compute=CREDITS,
        credits_used_cloud_services=CREDITS,
    ),
    "users": _table(user_id=T.LongType(), name=T.StringType()),
    "budget_history": _table(
        budget_name=T.StringType(),
        spending_limit=CREDITS,
        credit_quota=CREDITS,
        start_time=T.TimestampType(),
    ),
}


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select the canonical columns, cast to the canonical types.

    Column names match without regard to case; a missing column is an error and
    extra columns but the ``event_date`` partition are dropped. A TIMESTAMP_NTZ column is left as it is, since
    every report takes either kind. Columns already of the right type are
    passed through untouched, so filters on them still reach the scan.
    """
    wanted = TABLES[table]
    have = {name.lower(): name for name in df.columns}
    missing = [f.name for f in wanted if f.name not in have]
    if missing:
        raise ValueError(f"{table}: missing columns {', '.join(missing)}")
    columns = []
    if EVENT_DATE in have:
        columns.append(F.col(have[EVENT_DATE]).alias(EVENT_DATE))
    for field in wanted:
        source = have[field.name]
        actual = df.schema[source].dataType
        as_is = actual == field.dataType or (
            isinstance(field.dataType, T.TimestampType)
            and isinstance(actual, T.TimestampNTZType)
        )
        column = F.col(source)
        columns.append((column if as_is else column.cast(field.dataType)).alias(field.name))
    return df.select(columns)
