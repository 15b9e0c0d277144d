"""Values the public cost guides state, as far as they can be worked out."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from spendlens.functions.text import score_label
from spendlens.operators import prompts, tracking, waste
from spendlens.sources.rates import MODEL_RATES
from tests.util import SQL_CALL, cr, rows, ts


def test_calculator_default(spark):
    work = spark.createDataFrame(
        [("llama3.1-70b", 500, 200, 1000), ("no-such-model", 500, 200, 1000)],
        "model string, prompt_tokens bigint, response_tokens bigint, calls_per_day bigint",
    )
    known, unknown = sorted(rows(prompts.cost_plan(work)), key=lambda r: r[0] != "llama3.1-70b")
    assert known[4:] == (0.000847, 0.847, 25.41, 76.23, True)
    assert unknown[4:] == (None, None, None, None, False)


def test_worked_formula_and_batch_rate(spark):
    docs = spark.createDataFrame([("x" * 40_000,)], "text string")
    assert rows(prompts.estimate_batch(docs, rate="1.84", price=2)) == [
        (1, 10_000, 0.0184, 0.0368)
    ]


def test_prompt_overhead(spark):
    docs = spark.range(100_000).select(F.lit("x").alias("text"))
    n, tokens, credits, _ = rows(prompts.prompt_overhead(docs, 67, "1.84"))[0]
    assert (n, tokens) == (100_000, 6_700_000)
    assert round(credits, 1) == 12.3


def test_single_call_rate(spark):
    call = [("q", 1, None, "AI_FILTER", 726_907, cr("1.01"), None, ts("2024-01-30"))]
    usage = spark.createDataFrame(call, SQL_CALL)
    assert rows(waste.rate_per_million(usage, "2024-01-31")) == [
        (None, "AI_FILTER", 726_907, 1.01, 1.39)
    ]


def test_assistant_detail_sample(spark):
    sample = [
        (177, 19, "0.000449"),
        (193, 15, "0.000442"),
        (261, 18, "0.000579"),
        (180, 17, "0.000437"),
        (163, 19, "0.000426"),
        (180, 19, "0.000454"),
    ]
    usage = spark.createDataFrame(
        [
            ("someone", ts(f"2026-04-{20 - i}"), {"m": (a, b)}, a + b, cr(c))
            for i, (a, b, c) in enumerate(sample)
        ],
        "user_name string, event_timestamp timestamp_ntz, "
        "tokens_granular map<string, struct<input: bigint, output: bigint>>, "
        "total_tokens bigint, total_credits decimal(18,9)",
    )
    detail = tracking.assistant_detail(usage).collect()
    assert [r.tokens for r in detail] == [196, 208, 279, 197, 182, 199]
    assert sum(Decimal(str(r.credits)) for r in detail) == Decimal("0.002787")


def test_projection_of_five_rows(spark):
    calls = spark.createDataFrame(
        [(f"q{i}", cr("0.2")) for i in range(5)], "query_id string, credits decimal(18,9)"
    )
    fixed = tracking.project_cost(calls, [f"q{i}" for i in range(5)]).first()
    assert fixed.projected_500_rows == 100 * fixed.sample_credits
    assert fixed.projected_500k_rows == 100_000 * fixed.sample_credits
    scaled = {r.target_rows: r.projected_credits for r in tracking.project_to_rows(calls).collect()}
    assert scaled[500] == fixed.projected_500_rows
    assert scaled[500_000] == fixed.projected_500k_rows


def test_score_label(spark):
    scores = spark.createDataFrame([(0.31,), (0.3,), (-0.3,), (-0.31,)], "s double")
    assert [r[0] for r in scores.select(score_label(F.col("s"))).collect()] == [
        "Positive",
        "Neutral",
        "Neutral",
        "Negative",
    ]


# Tokens per credit of the printed rate table.
@pytest.mark.parametrize(
    ("model", "per_input", "per_output"),
    [
        ("mistral-7b", 8_333_333, 8_333_333),
        ("llama3.1-8b", 5_263_158, 5_263_158),
        ("llama3.1-70b", 826_446, 826_446),
        ("mistral-large2", 454_545, 454_545),
        ("llama3.1-405b", 333_333, 333_333),
        ("claude-4-sonnet", 666_667, 133_333),
    ],
)
def test_rates_agree_with_tokens_per_credit(model, per_input, per_output):
    rate = MODEL_RATES[model]
    assert round(1_000_000 / float(rate.input)) == per_input
    assert round(1_000_000 / float(rate.output)) == per_output
