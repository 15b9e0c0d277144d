"""Reports on amounts next to a rounding cut, and on rollups that were stored.

The amounts are fractions of micro-credits, so that cents and percents hang on the
last digits; the oracles work on whole nano-credits.
"""

from __future__ import annotations

from checks.catalog import BUILDS, ORACLES, QUERIES, TRAITS, Inputs, run_folder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from spendlens.operators import attribution, tracking, waste
from checks.fixtures import AS_OF
from spendlens.sources.logs import refresh_rollup

#: Credit columns of the tables that are made small.
AMOUNTS = {
    "ai_function_usage": ("credits",),
    "ai_sql_usage": ("token_credits",),
    "search_daily_usage": ("credits",),
    "metering_daily": ("credits_billed", "credits_used"),
}

NAMES = (
    "spend_by_function", "spend_by_user", "spend_by_user_from_rollup", "kpis", "tag_coverage",
    "model_tiers", "idle_services", "week_over_week", "week_over_week_calendar",
    "user_weekly_spike", "user_weekly_spike_from_rollup",
)


class SmallInputs(Inputs):
    """The tables with amounts cut to their last digits: below 1,009 nano-credits."""

    def __getattr__(self, name: str) -> DataFrame:
        df = super().__getattr__(name)
        nano = {c: (F.col(c) * 1_000_000_000).cast("bigint") % 1009 for c in AMOUNTS.get(name, ())}
        return df.withColumns(
            {c: (n * F.lit("0.000000001").cast("decimal(9,9)")).cast("decimal(18,9)") for c, n in nano.items()}
        )


def small_oracle(sql: str) -> str:
    """The same SQL over tables whose amounts are cut alike."""
    for view, columns in AMOUNTS.items():
        cut = ", ".join(
            f"CAST((CAST(CAST({c} AS DECIMAL(27,9)) * 1000000000 AS BIGINT) % 1009) "
            f"* CAST(0.000000001 AS DECIMAL(10,9)) AS DECIMAL(18,9)) AS {c}"
            for c in columns
        )
        if f"{view} AS (" in sql:
            head, _, rest = sql.partition(f"{view} AS (")
            depth, end = 1, 0
            while depth:
                depth += {"(": 1, ")": -1}.get(rest[end], 0)
                end += 1
            sql = f"{head}whole_{view} AS ({rest[:end]},\n{view} AS (SELECT * REPLACE ({cut}) FROM whole_{view}){rest[end:]}"
    return sql


def _register(name: str) -> None:
    QUERIES[f"{name}_small"] = lambda spark, sf_dir: BUILDS[name](SmallInputs(spark, sf_dir))
    ORACLES[f"{name}_small"] = small_oracle(ORACLES[name])
    TRAITS[f"{name}_small"] = TRAITS[name]


for _name in NAMES:
    _register(_name)

_stored: dict[tuple[str, str, str], str] = {}


def stored_rollup(t: Inputs, table: str, time_col: str, credit_col: str) -> DataFrame:
    """The rollup of a table as ``refresh_rollup`` left it; written once per session."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir, table)
    if key not in _stored:
        folder = run_folder(t.spark, "rollup")
        refresh_rollup(getattr(t, table), folder, time_col, credit_col)
        _stored[key] = folder
    return t.spark.read.parquet(_stored[key])


def _from_stored(name: str, source: tuple[str, str, str], build) -> None:
    QUERIES[f"{name}_stored_rollup"] = lambda spark, sf_dir: build(
        stored_rollup(Inputs(spark, sf_dir), *source), Inputs(spark, sf_dir)
    )
    ORACLES[f"{name}_stored_rollup"] = ORACLES[name]
    TRAITS[f"{name}_stored_rollup"] = TRAITS[name] | {"writes"}


_FUNCTIONS = ("ai_function_usage", "start_time", "credits")
_from_stored("spend_by_function", _FUNCTIONS, lambda r, t: tracking.spend_by_function(r, AS_OF))
_from_stored("spend_by_user", _FUNCTIONS, lambda r, t: attribution.spend_by_user(r, t.users, AS_OF))
_from_stored("rate_per_million", ("ai_sql_usage", "usage_time", "token_credits"),
             lambda r, t: waste.rate_per_million(r, AS_OF))
