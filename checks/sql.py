"""Pieces the oracle queries are put together from.

Oracles run in DuckDB. They round on integers (credits as whole nano-credits),
so both engines give the exact half-up result without agreeing on a DECIMAL
division.
"""

from __future__ import annotations

import re

from checks.fixtures import AS_OF, VIEWS

NOW = f"TIMESTAMP '{AS_OF}'"
TODAY = f"DATE '{AS_OF[:10]}'"


def view_sql(name: str) -> str:
    """A derived table's definition in DuckDB's words."""
    sql = VIEWS[name][1].replace("TIMESTAMP_NTZ", "TIMESTAMP").replace("AS STRING", "AS VARCHAR")
    return re.sub(r"array\(([^)]*)\)", r"[\1]", sql).strip()


def standalone(query: str, extra: str = "") -> str:
    """Put the views a query names in front of it, as CTEs.

    ``extra`` holds further CTEs, already in ``name AS (...)`` form; RECURSIVE may come first.
    """
    with_, extra = ("WITH RECURSIVE ", extra[10:]) if extra.startswith("RECURSIVE ") else ("WITH ", extra)
    named = [v for v in VIEWS if re.search(rf"\b{v}\b", query + extra)]
    ctes = [f"{v} AS ({view_sql(v)})" for v in named]
    if extra:
        ctes.append(extra.strip())
    head = with_ + ",\n".join(ctes) + "\n" if ctes else ""
    return head + query.strip()


def last(column: str, amount: int, unit: str = "DAY") -> str:
    """Window condition on a timestamp column."""
    return f"{column} BETWEEN {NOW} - INTERVAL {amount} {unit} AND {NOW}"


def last_dates(column: str, days: int) -> str:
    """Window condition on a date column."""
    return f"{column} BETWEEN {TODAY} - {days} AND {TODAY}"


def nano(column: str) -> str:
    """Sum of a DECIMAL(18,9) column in whole nano-credits."""
    return f"sum({nano_of(column)})"


def nano_of(column: str) -> str:
    exact = f"CAST({column} AS DECIMAL(27,9)) * CAST(1000000000 AS DECIMAL(11,0))"
    return f"CAST({exact} AS BIGINT)"


def half_up(numerator: str, denominator: str, digits: int) -> str:
    """numerator / denominator of integers, rounded half-up; NULL for zero."""
    n, m = f"CAST({numerator} AS HUGEINT)", f"CAST({denominator} AS HUGEINT)"
    scale = 10**digits
    return (
        f"CAST(CASE WHEN {m} = 0 THEN NULL ELSE sign({n}) * "
        f"((2 * abs({n}) * {scale} + abs({m})) // (2 * abs({m}))) * sign({m}) END AS DOUBLE)"
        f" / {scale}.0"
    )


def credits(column: str) -> str:
    """Sum of credits as DOUBLE."""
    return f"CAST({nano(column)} AS DOUBLE) / 1e9"


def rounded(column: str, digits: int) -> str:
    return half_up(nano(column), "1000000000", digits)


def average(column: str, digits: int) -> str:
    return half_up(nano(column), "1000000000 * count(*)", digits)


def dollars(column: str, digits: int = 2, price: int = 3) -> str:
    return half_up(f"{price} * {nano(column)}", "1000000000", digits)


# Metering types of AI services.
AI_TYPES = (
    "('AI_SERVICES','CORTEX_AGENTS','CORTEX_CODE_CLI','CORTEX_CODE_SNOWSIGHT','SNOWFLAKE_INTELLIGENCE')"
)

# What marks a statement as using an AI function.
AI_TEXT = "(" + " OR ".join(
    f"query_text ILIKE '%{word}%'"
    for word in (
        "AI_COMPLETE", "AI_SENTIMENT", "AI_CLASSIFY", "AI_TRANSLATE", "AI_SUMMARIZE",
        "AI_EMBED", "AI_FILTER", "AI_EXTRACT", "SNOWFLAKE.CORTEX",
    )
) + ")"
