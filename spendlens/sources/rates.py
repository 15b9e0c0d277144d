"""Model rates in credits per one million tokens."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from spendlens.functions.money import dec


class Rate(NamedTuple):
    input: str
    output: str
    tier: str | None = None


# Published calculator rates, and the models of the printed rate
# table that the calculator lacks (1,000,000 / tokens per credit).
MODEL_RATES: dict[str, Rate] = {
    "mistral-7b": Rate("0.12", "0.12", "Budget"),
    "llama3-8b": Rate("0.19", "0.19", "Budget"),
    "llama3.1-8b": Rate("0.19", "0.19", "Budget"),
    "mixtral-8x7b": Rate("0.22", "0.22", "Standard"),
    "reka-flash": Rate("0.45", "0.45"),
    "snowflake-arctic": Rate("0.84", "0.84", "Standard"),
    "llama3-70b": Rate("1.21", "1.21", "Standard"),
    "llama3.1-70b": Rate("1.21", "1.21", "Standard"),
    "mistral-large2": Rate("2.20", "2.20", "Standard"),
    "llama3.1-405b": Rate("3.00", "3.00", "Premium"),
    "mistral-large": Rate("5.10", "5.10", "Premium"),
    "claude-3-haiku": Rate("0.25", "1.25"),
    "claude-3-5-sonnet": Rate("1.50", "7.50"),
    "claude-4-sonnet": Rate("1.50", "7.50", "Premium"),
}

# Credits per one million characters.
CHARACTER_RATES: dict[str, str] = {"AI_SENTIMENT": "0.095", "AI_TRANSLATE": "0.333"}

RATE_TYPE = "decimal(12,6)"


def rate_of(model: str, rates: Mapping[str, Rate] = MODEL_RATES) -> Rate:
    if model not in rates:
        raise KeyError(f"no rate for model {model!r}")
    return rates[model]


def rate_rows(models, rates: Mapping[str, Rate] = MODEL_RATES) -> Column:
    """The given models as an array of structs to explode; unknown models get NULL rates."""
    rows = []
    for model in models:
        known = rates.get(model)
        rows.append(
            F.struct(
                F.lit(model).alias("model"),
                (dec(known.input) if known else F.lit(None)).cast(RATE_TYPE).alias("input"),
                (dec(known.output) if known else F.lit(None)).cast(RATE_TYPE).alias("output"),
            )
        )
    return F.array(*rows)


def rate_lookup(model: Column, side: str, rates: Mapping[str, Rate] = MODEL_RATES) -> Column:
    """Rate of the row's model, NULL for a model without one."""
    pairs = []
    for name, rate in rates.items():
        pairs += [F.lit(name), dec(getattr(rate, side)).cast(RATE_TYPE)]
    return F.create_map(*pairs)[model]
