from datetime import datetime
from decimal import Decimal

CALL = (
    "query_id string, user_id bigint, function_name string, model_name string, "
    "credits decimal(18,9), start_time timestamp_ntz, role_names array<string>"
)
SQL_CALL = (
    "query_id string, user_id bigint, model_name string, function_name string, tokens bigint, "
    "token_credits decimal(18,9), query_tag string, usage_time timestamp_ntz"
)
METERING = (
    "usage_date date, service_type string, credits_used decimal(18,9), "
    "credits_billed decimal(18,9)"
)


def ts(text):
    return datetime.fromisoformat(text)


def cr(value):
    return Decimal(str(value))


def rows(df):
    return [tuple(r) for r in df.collect()]
