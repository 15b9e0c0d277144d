"""Pre-flight work on prompt tables: size, cost, trimming, dedupe, labelling."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlens.functions.money import (
    PRICE_PER_CREDIT,
    dec,
    dollars,
    ratio,
    rounded,
)
from spendlens.functions.text import (
    FILLER_PHRASES,
    estimate_tokens,
    estimate_tokens_of,
    phrase_pattern,
    score_label,
)
from spendlens.functions.time import literal_like, parse_as_of, recent
from spendlens.plans.skew import hot_keys, lookup
from spendlens.sources.labels import LabelCache
from spendlens.sources.rates import (
    CHARACTER_RATES,
    MODEL_RATES,
    Rate,
    rate_lookup,
    rate_of,
    rate_rows,
)

DAYS_PER_MONTH = 30


def _prompt(text: str, prefix: str) -> Column:
    return F.concat(F.lit(prefix), F.col(text)) if prefix else F.col(text)


def _million(amount: Column, rate: Column) -> Column:
    """Exact ``amount * rate / 1,000,000``."""
    return amount.cast("decimal(16,0)") * rate.cast("decimal(12,6)") * dec("0.000001")


def token_estimates(docs, text="text", key="doc_id") -> DataFrame:
    """Token estimates per row, by characters and by words."""
    return docs.select(
        key,
        estimate_tokens(F.col(text)).alias("tokens_by_chars"),
        estimate_tokens(F.col(text), "words").alias("tokens_by_words"),
    )


def preflight_filter(docs, max_tokens=10_000, text="text", prefix="") -> DataFrame:
    """Rows whose prompt stays under ``max_tokens``, with the estimate."""
    return docs.withColumn("est_tokens", estimate_tokens(_prompt(text, prefix))).where(
        F.col("est_tokens") < max_tokens
    )


def prompt_size_audit(docs, n=50, text="text", key="doc_id") -> DataFrame:
    """The ``n`` largest prompts."""
    return (
        docs.select(key, estimate_tokens(F.col(text)).alias("token_count"))
        .orderBy(F.desc_nulls_first("token_count"), key)
        .limit(n)
    )


def estimate_batch(
    docs,
    model="mistral-7b",
    text="text",
    prefix="",
    rate=None,
    price=PRICE_PER_CREDIT,
    rates: Mapping[str, Rate] = MODEL_RATES,
) -> DataFrame:
    """Rows, input tokens, credits and dollars to run one model over the table.

    ``rate`` (credits per 1M tokens) replaces the model's input rate.
    """
    per_1m = dec(rate if rate is not None else rate_of(model, rates).input)
    cost = _million(F.col("tokens"), per_1m)
    return docs.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.coalesce(F.sum(estimate_tokens(_prompt(text, prefix))), F.lit(0)).alias("tokens"),
    ).select(
        "total_rows",
        F.col("tokens").alias("total_input_tokens"),
        rounded(cost, 6).alias("est_credits"),
        dollars(cost, price, 4).alias("est_dollars"),
    )


def compare_models_on_table(
    docs,
    models: Sequence[str] | None = None,
    text="text",
    prefix="",
    price=PRICE_PER_CREDIT,
    rates: Mapping[str, Rate] = MODEL_RATES,
) -> DataFrame:
    """Input cost of one prompt set under each model; the table is read once."""
    cost = _million(F.col("tokens"), F.col("r.input"))
    return (
        docs.agg(
            F.count(F.lit(1)).alias("total_rows"),
            F.coalesce(F.sum(estimate_tokens(_prompt(text, prefix))), F.lit(0)).alias("tokens"),
        )
        .select("*", F.explode(rate_rows(models or list(rates), rates)).alias("r"))
        .select(
            F.col("r.model").alias("model"),
            "total_rows",
            F.col("tokens").alias("total_input_tokens"),
            rounded(cost, 6).alias("est_credits"),
            dollars(cost, price, 4).alias("est_dollars"),
        )
        .orderBy(F.asc_nulls_last("est_credits"), "model")
    )


def workloads(calls, as_of, days=30, time_col="usage_time") -> DataFrame:
    """The mean call of each model and function over a window, and its calls per day.

    Whole tokens and calls, cut off; the input of a plan that goes on as before.
    """
    whole = lambda part, by: F.call_function("div", F.col(part), by)
    return (
        recent(calls, time_col, as_of, days=days)
        .groupBy("model_name", "function_name")
        .agg(
            F.sum("tokens_granular.input").alias("i"),
            F.sum("tokens_granular.output").alias("o"),
            F.count(F.lit(1)).alias("n"),
        )
        .select(
            F.col("model_name").alias("model"),
            "function_name",
            whole("i", F.col("n")).alias("prompt_tokens"),
            whole("o", F.col("n")).alias("response_tokens"),
            whole("n", F.lit(days)).alias("calls_per_day"),
        )
    )


def cost_plan(
    workloads, price=PRICE_PER_CREDIT, rates: Mapping[str, Rate] = MODEL_RATES
) -> DataFrame:
    """Credits per call, day and 30-day month, and dollars per month.

    ``workloads`` has model, prompt_tokens, response_tokens and calls_per_day.
    A model without a rate gets NULL costs and ``known_model`` false.
    """
    model = F.col("model")
    call = _million(F.col("prompt_tokens"), rate_lookup(model, "input", rates)) + _million(
        F.col("response_tokens"), rate_lookup(model, "output", rates)
    )
    day = F.col("call").cast("decimal(27,12)") * F.col("calls_per_day").cast("decimal(10,0)")
    return workloads.withColumn("call", call).select(
        *workloads.columns,
        rounded(F.col("call"), 6).alias("credits_per_call"),
        rounded(day, 4).alias("daily_credits"),
        rounded(day * dec(DAYS_PER_MONTH), 2).alias("monthly_credits"),
        rounded(day * dec(DAYS_PER_MONTH) * dec(price), 2).alias("monthly_dollars"),
        F.col("call").isNotNull().alias("known_model"),
    )


def character_billed_cost(
    docs,
    function,
    text="text",
    price=PRICE_PER_CREDIT,
    rates: Mapping[str, str] = CHARACTER_RATES,
) -> DataFrame:
    """Cost of a function billed by characters over the whole table."""
    cost = _million(F.col("total_chars"), dec(rates[function]))
    return docs.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.coalesce(F.sum(F.length(text)), F.lit(0)).alias("total_chars"),
    ).select(
        F.lit(function).alias("function_name"),
        "total_rows",
        "total_chars",
        rounded(cost, 6).alias("est_credits"),
        dollars(cost, price, 4).alias("est_dollars"),
    )


def truncate_inputs(docs, n=500, text="text") -> DataFrame:
    """Replace the text by its first ``n`` characters; adds the tokens saved."""
    cut = F.left(F.col(text), F.lit(n))
    return docs.withColumn(
        "tokens_saved", estimate_tokens(F.col(text)) - estimate_tokens(cut)
    ).withColumn(text, cut)


def context_fit(docs, limit, text="text", prefix="") -> DataFrame:
    """Total rows, rows that fit a context of ``limit`` tokens, rows that fail."""
    fits = estimate_tokens(_prompt(text, prefix)) <= limit
    return docs.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count(F.when(fits, 1)).alias("successful_rows")
    ).withColumn("failed_rows", F.col("total_rows") - F.col("successful_rows"))


def new_rows_only(source, ledger, key="doc_id") -> DataFrame:
    """Rows whose key the ledger does not hold yet."""
    return source.join(ledger.select(key), key, "left_anti")


def _hashed(docs: DataFrame, text: str) -> DataFrame:
    """Rows with a text, and the hash that stands for it in shuffles."""
    rows = docs.withColumn("text_hash", F.sha2(F.col(text), 256))
    return rows.where(F.col(text).isNotNull() & F.col("text_hash").isNotNull())


def _text_groups(hashed: DataFrame, key: str) -> DataFrame:
    """Per distinct text its first key and number of copies."""
    return hashed.groupBy("text_hash").agg(
        F.min(key).alias("input_key"), F.count(F.lit(1)).alias("copies")
    )


def dedupe_inputs(docs, text="text", key="doc_id") -> tuple[DataFrame, DataFrame]:
    """Distinct texts to process, and the map from every row back to its text.

    The first frame holds one row of ``docs`` per distinct text, under its
    smallest key. The second has (key, input_key, copies), one row for each row of
    ``docs`` with a text, whether keys repeat or not. Only keys and hashes are
    shuffled for the map, and a text copied into a large share of the rows is
    split over many tasks. For the first frame each distinct text moves once, copies
    in one task being put together before.
    """
    hashed = _hashed(docs, text)
    groups = _text_groups(hashed, key)
    mapping = lookup(
        hashed.select(key, "text_hash"),
        groups,
        "text_hash",
        hot_keys(groups, "text_hash", "copies"),
        row_id=key,
    )
    order = F.struct(F.col(key).isNull(), F.col(key))
    first = hashed.groupBy("text_hash").agg(
        F.min_by(F.struct(*docs.columns), order).alias("first")
    )
    return first.select("first.*"), mapping.drop("text_hash")


Scorer = Callable[[pd.Series], pd.DataFrame]


def enrich(
    docs,
    scorer: Scorer,
    schema: str | T.StructType,
    text="text",
    key="doc_id",
    max_tokens: int | None = None,
    ledger: DataFrame | None = None,
) -> DataFrame:
    """Label every text with a caller's vectorised scorer.

    The scorer takes a Series of texts and returns a frame with the columns of
    ``schema`` in the same row order. Rows in ``ledger`` are left out, each
    distinct text is scored once, and a text over ``max_tokens`` keeps its row
    with NULL labels instead of failing the batch. Returns key and labels, one row for
    each row of ``docs``, whether keys repeat or not.
    """
    if ledger is not None:
        docs = new_rows_only(docs, ledger, key)
    fields = _fields(docs, schema)
    labels = [f.name for f in fields]
    text_hash = F.sha2(F.col(text), 256)
    if max_tokens is not None:
        text_hash = F.when(estimate_tokens(F.col(text)) <= max_tokens, text_hash)
    rows = docs.select(F.col(key), text_hash.alias("text_hash"))
    groups = (
        rows.where(F.col("text_hash").isNotNull())
        .groupBy("text_hash")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    # The hash goes along with the text, so labels come back keyed by it. This is the
    # only shuffle of texts: each one to be scored moves once.
    unique = (
        docs.select(F.col(text).alias("_text"), text_hash.alias("text_hash"))
        .where(F.col("text_hash").isNotNull())
        .groupBy("text_hash")
        .agg(F.any_value("_text").alias("_text"))
    )

    scored = _scored(unique, scorer, fields)
    hot = hot_keys(groups, "text_hash", "copies")
    return lookup(rows, scored, "text_hash", hot, row_id=key).select(key, *labels)


def hashed_inputs(docs, folder: str, text="text", key="doc_id", max_tokens: int | None = None) -> DataFrame:
    """Key and text hash of every row, written to ``folder`` and read back.

    The one pass over all texts: what groups, matches or counts texts reads this table.
    A text over ``max_tokens`` and a missing one have no hash.
    """
    text_hash = F.sha2(F.col(text), 256)
    if max_tokens is not None:
        text_hash = F.when(estimate_tokens(F.col(text)) <= max_tokens, text_hash)
    rows = docs.select(F.col(key), text_hash.alias("text_hash"))
    rows.write.mode("overwrite").parquet(folder)
    return docs.sparkSession.read.schema(rows.schema).parquet(folder)


def enrich_cached(
    docs,
    scorer: Scorer,
    cache: LabelCache,
    version: str,
    folder: str,
    text="text",
    key="doc_id",
    max_tokens: int | None = None,
) -> DataFrame:
    """As ``enrich``, but a text is scored once per ``version`` of the scorer, over all runs.

    Labels are kept in ``cache`` by text hash. All texts are read once, to be hashed into
    ``folder``; only where some are new they are read again, and of those one row
    each goes to the scorer. A run that was cut off scores what is still missing.
    """
    rows = hashed_inputs(docs, folder, text, key, max_tokens)
    groups = (
        rows.where(F.col("text_hash").isNotNull())
        .groupBy("text_hash")
        .agg(F.min(key).alias("_key"), F.count(F.lit(1)).alias("copies"))
    )
    # Only the asked hashes move here; the cache is read as it lies.
    unseen = groups.join(cache.of(version), "text_hash", "left_anti").select("text_hash", "_key")
    if not unseen.isEmpty():
        own_hash = F.sha2(F.col(text), 256)
        there = docs.select(F.col(key).alias("_own"), F.col(text).alias("_text"), own_hash.alias("_hash"))
        same = F.col("_own").eqNullSafe(F.col("_key")) & (F.col("_hash") == F.col("text_hash"))
        unique = (
            there.join(unseen, same).groupBy("text_hash").agg(F.any_value("_text").alias("_text"))
        )
        fields = [f for f in cache.spark.table(cache.name).schema if f.name in cache.labels]
        cache.add(_scored(unique, scorer, fields), version)
    found = groups.select("text_hash").join(cache.of(version), "text_hash")
    hot = hot_keys(groups, "text_hash", "copies")
    return lookup(rows, found, "text_hash", hot, row_id=key).select(key, *cache.labels)


def _scored(unique: DataFrame, scorer: Scorer, fields: list[T.StructField]) -> DataFrame:
    """Labels of (text_hash, _text) rows; the hash goes along with the text."""
    labels = [f.name for f in fields]

    def score(batches):
        for batch in batches:
            scored = scorer(batch["_text"]).reset_index(drop=True)
            scored.insert(0, "text_hash", batch["text_hash"].to_numpy())
            yield scored[["text_hash", *labels]]

    return unique.mapInPandas(score, T.StructType([T.StructField("text_hash", T.StringType()), *fields]))


def _fields(docs: DataFrame, schema: str | T.StructType) -> list[T.StructField]:
    if isinstance(schema, str):
        schema = docs.sparkSession.createDataFrame([], schema).schema
    return list(schema.fields)


def sentiment_labels(scored, score="score", low=-0.3, high=0.3) -> DataFrame:
    """Add the Positive, Negative or Neutral label of a score."""
    return scored.withColumn("sentiment_label", score_label(F.col(score), low, high))


def cost_index(costs, baseline, model="model", cost="credits") -> DataFrame:
    """Each model's cost over the baseline model's, one decimal.

    NULL where either cost is missing or not positive. ``costs`` has one row
    per model; the baseline enters as a scalar subquery.
    """
    base = costs.where(F.col(model) == baseline).select(F.max(cost)).scalar()
    return (
        costs.withColumn("_base", base)
        .select(
            *costs.columns,
            rounded(
                F.when(
                    (F.col("_base") > 0) & (F.col(cost) > 0),
                    ratio(F.col(cost), F.col("_base")),
                ),
                1,
            ).alias("cost_index"),
        )
        .orderBy(F.desc_nulls_last("cost_index"), model)
    )


def prompt_filler_scan(
    docs, phrases: Sequence[str] = FILLER_PHRASES, text="text", key="doc_id"
) -> DataFrame:
    """Rows with filler phrases: how many, and the tokens their removal saves."""
    column = F.col(text)
    found = F.regexp_extract_all(column, F.lit(phrase_pattern(phrases)), F.lit(0))
    rows = docs.select(key, F.length(column).alias("chars"), found.alias("found"))
    tokens = estimate_tokens_of(F.col("chars"))
    lean = F.col("chars") - F.length(F.array_join("found", ""))
    return rows.where(F.size("found") > 0).select(
        key,
        F.size("found").cast("bigint").alias("phrases"),
        tokens.alias("tokens"),
        (tokens - estimate_tokens_of(lean)).alias("tokens_saved"),
    )


def prompt_overhead(
    docs, overhead_tokens: int, rate, text="text", price=PRICE_PER_CREDIT
) -> DataFrame:
    """Cost of ``overhead_tokens`` repeated in front of every non-NULL text."""
    cost = _million(F.col("total_rows") * F.lit(overhead_tokens), dec(rate))
    return docs.agg(F.count(text).alias("total_rows")).select(
        "total_rows",
        (F.col("total_rows") * F.lit(overhead_tokens)).alias("overhead_tokens"),
        rounded(cost, 6).alias("overhead_credits"),
        dollars(cost, price, 4).alias("overhead_dollars"),
    )


def feedback_table(customer, nation, as_of, comments=None, limit: int | None = None) -> DataFrame:
    """Feedback table: customers with their country and comment text.

    ``comments`` (customer_id, feedback_text) supplies the text; without it the
    customer table must have c_comment. A sample is asked for by its ``limit``: the
    lowest customer ids, the same in every run.
    """
    moment = parse_as_of(as_of)
    if comments is None:
        picked = customer.withColumn("feedback_text", F.col("c_comment"))
    else:
        text = comments.select(
            F.col("customer_id").alias("c_custkey"), "feedback_text"
        )
        picked = customer.join(text, "c_custkey", "left")
    rows = picked.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        "feedback_text",
        F.col("c_mktsegment").alias("market_segment"),
        F.col("c_acctbal").alias("account_balance"),
        F.col("n_name").alias("country"),
        literal_like(moment, T.TimestampNTZType()).alias("loaded_at"),
    )
    return rows if limit is None else rows.orderBy("customer_id").limit(limit)


def feedback_preview(feedback, limit=5) -> DataFrame:
    """First rows of the feedback table with an 80-character preview."""
    return (
        feedback.select(
            "customer_id",
            "customer_name",
            F.left("feedback_text", F.lit(80)).alias("feedback_preview"),
            "market_segment",
            "country",
        )
        .orderBy("customer_id")
        .limit(limit)
    )
