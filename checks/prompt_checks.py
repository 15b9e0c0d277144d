"""Queries and oracles of the prompt and pre-flight jobs."""

from checks.catalog import query, run_folder
from checks.sql import NOW, average, half_up, last, nano_of
from pyspark.sql import functions as F
from pyspark.sql import types as T
from spendlens.operators import prompts
from spendlens.sources import keyed, logs
from spendlens.sources.labels import open_cache
from spendlens.sources.ledger import Ledger
from checks.fixtures import AS_OF

PREFIX = "Summarize: "


def tokens(text="text"):
    return f"CAST(ceil(length({text}) / 4.0) AS BIGINT)"


@query(
    "token_estimates",
    f"""
SELECT doc_id, {tokens()} AS tokens_by_chars,
  CAST(ceil(len(regexp_extract_all(text, '\\S+')) / 0.75) AS BIGINT) AS tokens_by_words
FROM documents""",
)
def _(t):
    return prompts.token_estimates(t.documents)


@query(
    "preflight_filter",
    f"SELECT doc_id, {tokens()} AS est_tokens FROM documents WHERE {tokens()} < 1000",
)
def _(t):
    return prompts.preflight_filter(t.documents, max_tokens=1000).select("doc_id", "est_tokens")


@query(
    "prompt_size_audit",
    f"SELECT doc_id, {tokens()} AS token_count FROM documents ORDER BY token_count DESC, doc_id LIMIT 50",
)
def _(t):
    return prompts.prompt_size_audit(t.documents)


TOTAL = f"sum({tokens(chr(39) + PREFIX + chr(39) + ' || text')})"


@query(
    "estimate_batch",
    f"""
SELECT count(*) AS total_rows, CAST({TOTAL} AS BIGINT) AS total_input_tokens,
  {half_up(f'12 * {TOTAL}', '100000000', 6)} AS est_credits, {half_up(f'36 * {TOTAL}', '100000000', 4)} AS est_dollars
FROM documents""",
)
def _(t):
    return prompts.estimate_batch(t.documents, "mistral-7b", prefix=PREFIX)


@query(
    "compare_models_on_table",
    f"""
SELECT r.model, count(*) AS total_rows, CAST({TOTAL} AS BIGINT) AS total_input_tokens,
  {half_up(f'max(r.rate) * {TOTAL}', '100000000', 6)} AS est_credits,
  {half_up(f'3 * max(r.rate) * {TOTAL}', '100000000', 4)} AS est_dollars
FROM documents, rates r GROUP BY r.model""",
    """rates AS (SELECT * FROM (VALUES ('mistral-7b', 12), ('llama3.1-70b', 121), ('mistral-large2', 220),
  ('claude-4-sonnet', 150)) AS v(model, rate))""",
)
def _(t):
    models = ["mistral-7b", "llama3.1-70b", "mistral-large2", "claude-4-sonnet"]
    return prompts.compare_models_on_table(t.documents, models, prefix=PREFIX)


# Workloads: the mean call of each model and function, and its calls per day.
WORKLOADS = f"""workloads AS (
SELECT CASE WHEN function_name = 'AI_AGG' THEN 'unlisted-model' ELSE model_name END AS model, function_name,
  model_name AS ran_on, CAST(sum(input_tokens) // count(*) AS BIGINT) AS prompt_tokens,
  CAST(sum(output_tokens) // count(*) AS BIGINT) AS response_tokens, count(*) // 30 AS calls_per_day
FROM ai_sql_usage WHERE {last('usage_time', 30)} GROUP BY model_name, function_name),
priced AS (
SELECT w.*, w.prompt_tokens * r.input_rate + w.response_tokens * r.output_rate AS unit
FROM workloads w LEFT JOIN (VALUES ('mistral-7b', 12, 12), ('llama3.1-70b', 121, 121), ('mistral-large2', 220, 220),
  ('claude-4-sonnet', 150, 750)) AS r(model, input_rate, output_rate) ON w.model = r.model)"""


@query(
    "cost_plan",
    f"""
SELECT model, function_name, ran_on, prompt_tokens, response_tokens, calls_per_day,
  {half_up('unit', '100000000', 6)} AS credits_per_call, {half_up('unit * calls_per_day', '100000000', 4)} AS daily_credits,
  {half_up('30 * unit * calls_per_day', '100000000', 2)} AS monthly_credits,
  {half_up('90 * unit * calls_per_day', '100000000', 2)} AS monthly_dollars, unit IS NOT NULL AS known_model
FROM priced""",
    WORKLOADS,
)
def _(t):
    # Calls of one function are planned on a model that has no rate.
    planned = F.when(F.col("function_name") == "AI_AGG", "unlisted-model").otherwise(F.col("model"))
    workloads = prompts.workloads(t.ai_sql_usage, AS_OF, 30).withColumn("ran_on", F.col("model")).withColumn("model", planned)
    return prompts.cost_plan(workloads)


def _characters(function, rate):
    return f"""
SELECT '{function}' AS function_name, count(*) AS total_rows, CAST(sum(length(text)) AS BIGINT) AS total_chars,
  {half_up(f'{rate} * sum(length(text))', '1000000000', 6)} AS est_credits,
  {half_up(f'3 * {rate} * sum(length(text))', '1000000000', 4)} AS est_dollars FROM documents"""


@query("character_billed_sentiment", _characters("AI_SENTIMENT", 95))
def _(t):
    return prompts.character_billed_cost(t.documents, "AI_SENTIMENT")


@query("character_billed_translate", _characters("AI_TRANSLATE", 333))
def _(t):
    return prompts.character_billed_cost(t.documents, "AI_TRANSLATE")


@query(
    "truncate_inputs",
    f"""
SELECT doc_id, substr(text, 1, 500) AS text, {tokens()} - {tokens('substr(text, 1, 500)')} AS tokens_saved
FROM documents""",
)
def _(t):
    return prompts.truncate_inputs(t.documents, 500).select("doc_id", "text", "tokens_saved")


@query(
    "context_fit",
    f"""
SELECT count(*) AS total_rows, count(*) FILTER (WHERE {tokens()} <= 1000) AS successful_rows,
  count(*) FILTER (WHERE {tokens()} > 1000) AS failed_rows FROM documents""",
)
def _(t):
    return prompts.context_fit(t.documents, limit=1000)


@query(
    "new_rows_only",
    "SELECT doc_id, lang, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def _(t):
    return prompts.new_rows_only(t.documents, t.labels).select("doc_id", "lang", "source")


@query(
    "dedupe_inputs_mapping",
    """
SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS input_key, count(*) OVER (PARTITION BY text) AS copies
FROM documents""",
)
def _(t):
    return prompts.dedupe_inputs(t.documents)[1]


@query(
    "dedupe_inputs_unique",
    """
SELECT doc_id, text, lang FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM documents e WHERE e.text = d.text AND e.doc_id < d.doc_id)""",
)
def _(t):
    return prompts.dedupe_inputs(t.documents)[0].select("doc_id", "text", "lang")


def _length_scorer():
    """A stand-in for a model: a score and a size class from the text length."""

    def score(texts):
        import pandas as pd

        length = texts.str.len()
        return pd.DataFrame(
            {
                "score": (length % 201 - 100) / 100.0,
                "size_class": (length // 1000).astype("int64"),
            }
        )

    return score


SCORED = f"""scored AS (
SELECT doc_id, CASE WHEN {tokens()} <= 1000 THEN (length(text) % 201 - 100) / 100.0 END AS score,
  CASE WHEN {tokens()} <= 1000 THEN length(text) // 1000 END AS size_class
FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))"""


@query(
    "enrich_new_rows",
    """
SELECT doc_id, CAST(score AS DOUBLE) AS score, CAST(size_class AS BIGINT) AS size_class,
  CASE WHEN score > 0.3 THEN 'Positive' WHEN score < -0.3 THEN 'Negative' ELSE 'Neutral' END AS sentiment_label
FROM scored""",
    SCORED,
    traits=("python",),
)
def _(t):
    scored = prompts.enrich(
        t.documents,
        _length_scorer(),
        "score double, size_class bigint",
        max_tokens=1000,
        ledger=t.labels,
    )
    return prompts.sentiment_labels(scored)


@query(
    "enrich_cached",
    f"""
SELECT doc_id, CASE WHEN {tokens()} <= 1000 THEN (length(text) % 201 - 100) / 100.0 END::DOUBLE AS score,
  CAST(CASE WHEN {tokens()} <= 1000 THEN length(text) // 1000 END AS BIGINT) AS size_class FROM documents""",
    traits=("python", "writes"),
)
def _(t):
    """The English rows first, then all; the second run scores the texts that are new."""
    folder = run_folder(t.spark, "labels")
    labels = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("size_class", T.LongType())])
    cache = open_cache(t.spark, f"{folder}/cache", labels, buckets=16)
    for n, docs in enumerate((t.documents.where("lang = 'en'"), t.documents)):
        found = prompts.enrich_cached(docs, _length_scorer(), cache, "v1", f"{folder}/{n}", max_tokens=1000)
    return found


# Three keys for all documents: every row must come back once.
REPEATED = f"""scored AS (
SELECT doc_id % 3 AS doc_id, CASE WHEN {tokens()} <= 1000 THEN (length(text) % 201 - 100) / 100.0 END AS score
FROM documents)"""


@query("enrich_repeated_keys", "SELECT doc_id, CAST(score AS DOUBLE) AS score FROM scored", REPEATED, traits=("python",))
def _(t):
    docs = t.documents.withColumn("doc_id", F.col("doc_id") % 3)
    scored = prompts.enrich(docs, _length_scorer(), "score double, size_class bigint", max_tokens=1000)
    return scored.select("doc_id", "score")


@query(
    "dedupe_inputs_repeated_keys",
    "SELECT text, min(doc_id % 3) AS doc_id FROM documents WHERE text IS NOT NULL GROUP BY text",
)
def _(t):
    docs = t.documents.withColumn("doc_id", F.col("doc_id") % 3)
    return prompts.dedupe_inputs(docs)[0].select("text", "doc_id")


@query(
    "ledger_round",
    "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND lang <> 'en'",
    traits=("writes",),
)
def _(t):
    """Filter, process the English rows, append them to the ledger, filter again."""
    ledger = run_folder(t.spark, "ledger")
    logs.append_ledger(t.labels, ledger, "doc_id")
    new = prompts.new_rows_only(t.documents, logs.read_ledger(t.spark, ledger, "doc_id bigint"))
    logs.append_ledger(new.where("lang = 'en'"), ledger, "doc_id")
    held = logs.read_ledger(t.spark, ledger, "doc_id bigint")
    return prompts.new_rows_only(t.documents, held).select("doc_id", "lang")


@query(
    "bucketed_ledger",
    "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND lang <> 'en'",
    traits=("writes",),
)
def _(t):
    """The round of ``ledger_round`` on the ledger with buckets and filters."""
    ledger = Ledger(t.spark, run_folder(t.spark, "bucketed-ledger"), T.StructField("doc_id", T.LongType()), buckets=16, bits=1 << 17)
    ledger.append(t.labels)
    ledger.append(ledger.new_rows(t.documents).where("lang = 'en'"))
    return ledger.new_rows(t.documents).select("doc_id", "lang")


@query(
    "update_processed",
    """
SELECT d.doc_id, lang, CASE WHEN lang = 'en' OR quality = 0 THEN TIMESTAMP '2024-01-31 00:00:00' END AS processed_at,
  CAST(quality AS BIGINT) AS quality
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
UNION ALL SELECT -1, NULL, NULL, 1""",
    traits=("writes",),
)
def _(t):
    """A keyed table marked by condition, then given a new column by key, and marked by that."""
    path = run_folder(t.spark, "reviews")
    now = F.lit(AS_OF).cast("timestamp_ntz")
    rows = t.documents.select("doc_id", "lang").withColumn("processed_at", F.lit(None).cast("timestamp_ntz"))
    keyed.create_keyed(rows, path, "doc_id")
    keyed.update_where(t.spark, path, F.col("processed_at").isNull() & (F.col("lang") == "en"), {"processed_at": now})
    added = t.spark.createDataFrame([(-1, 1)], "doc_id bigint, quality bigint")
    keyed.upsert(t.labels.select("doc_id", F.col("quality").cast("bigint")).unionByName(added), path)
    keyed.update_where(t.spark, path, F.col("quality") == 0, {"processed_at": now})
    return keyed.read_keyed(t.spark, path)


@query(
    "sentiment_labels",
    """
SELECT doc_id, CASE WHEN quality - toxic > 0.3 THEN 'Positive' WHEN quality - toxic < -0.3 THEN 'Negative'
  ELSE 'Neutral' END AS sentiment_label FROM labels""",
)
def _(t):
    scored = t.labels.withColumn("score", (F.col("quality") - F.col("toxic")).cast("double"))
    return prompts.sentiment_labels(scored).select("doc_id", "sentiment_label")


@query(
    "cost_index",
    f"""
SELECT model, credits, CASE WHEN base > 0 AND credits_nano > 0 THEN {half_up('credits_nano * base_n', 'base * n', 1)} END AS cost_index
FROM (SELECT model_name AS model, {average('token_credits', 9)} AS credits, sum({nano_of('token_credits')}) AS credits_nano,
        count(*) AS n, (SELECT sum({nano_of('token_credits')}) FROM ai_sql_usage WHERE model_name = 'mistral-7b') AS base,
        (SELECT count(*) FROM ai_sql_usage WHERE model_name = 'mistral-7b') AS base_n
      FROM ai_sql_usage GROUP BY 1) per_model""",
)
def _(t):
    costs = t.ai_sql_usage.groupBy(F.col("model_name").alias("model")).agg(
        (F.sum("token_credits") / F.count(F.lit(1))).alias("credits")
    )
    index = prompts.cost_index(costs, "mistral-7b")
    return index.withColumn("credits", F.round("credits", 9).cast("double"))


PHRASES = ("of the", "as an", "you are")
PATTERN = "(?i)" + "|".join(PHRASES)


@query(
    "prompt_filler_scan",
    f"""
SELECT doc_id, len(regexp_extract_all(text, '{PATTERN}')) AS phrases, {tokens()} AS tokens,
  {tokens()} - {tokens(f"regexp_replace(text, '{PATTERN}', '', 'g')")} AS tokens_saved
FROM documents WHERE regexp_matches(text, '{PATTERN}')""",
)
def _(t):
    return prompts.prompt_filler_scan(t.documents, PHRASES)


@query(
    "prompt_overhead",
    f"""
SELECT count(text) AS total_rows, 67 * count(text) AS overhead_tokens,
  {half_up('184 * 67 * count(text)', '100000000', 6)} AS overhead_credits,
  {half_up('3 * 184 * 67 * count(text)', '100000000', 4)} AS overhead_dollars FROM documents""",
)
def _(t):
    return prompts.prompt_overhead(t.documents, 67, "1.84")


FEEDBACK = f"""
SELECT c_custkey AS customer_id, c_name AS customer_name, d.text AS feedback_text, c_mktsegment AS market_segment,
  c_acctbal AS account_balance, n_name AS country, {NOW} AS loaded_at
FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN documents d ON d.doc_id = c_custkey"""


def _feedback(t, limit):
    comments = t.documents.select(
        F.col("doc_id").alias("customer_id"), F.col("text").alias("feedback_text")
    )
    return prompts.feedback_table(t.customer, t.nation, AS_OF, comments, limit)


@query("feedback_table", FEEDBACK)
def _(t):
    return _feedback(t, None)


@query("feedback_table_sample", FEEDBACK + " ORDER BY c_custkey LIMIT 500")
def _(t):
    return _feedback(t, 500)


@query("feedback_row_count", f"SELECT count(*) AS row_count FROM ({FEEDBACK}) f")
def _(t):
    return _feedback(t, None).agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "feedback_preview",
    f"""
SELECT customer_id, customer_name, substr(feedback_text, 1, 80) AS feedback_preview, market_segment, country
FROM ({FEEDBACK}) f ORDER BY customer_id LIMIT 5""",
)
def _(t):
    return prompts.feedback_preview(_feedback(t, None))
