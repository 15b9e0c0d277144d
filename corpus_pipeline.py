"""Corpus pipeline: each stage applies one training-data operator to what the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.llm import bpe, checks, lines, simhash, toxicity, winnow
from spendlens.llm.common import stored


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose toxicity reaches the threshold, learnt from ``labels``.

    Null and empty texts have a score like any other; all columns stay.
    """
    labels = checks.table(spark, sf_dir, "labels")
    scored = toxicity.with_toxicity(docs, toxicity.learn(docs, labels))
    return scored.where(F.col("score") < toxicity.THRESHOLD).select(*docs.columns)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut lines that an earlier document holds; ``n_chars`` follows the text.

    Every document stays, a null text as an empty one.
    """
    kept = lines.dedup_lines(docs)
    return kept.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate group, the one with the smallest id.

    Documents without words are one group. Rows that repeat id and text are one.
    """
    return simhash.one_of_each(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of a ``benchmark`` item; all others stay as they are."""
    return winnow.clean_documents(docs, checks.table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode each text; ``intact`` says that decoding its ids gives the text back.

    Null and empty texts have no ids. Returns doc_id, lang, source, ids, n_tokens, intact.
    """
    model = checks.byte_bpe_model()
    ids = bpe.encode(docs, model, public_tokenizers.PATTERN)
    text = F.coalesce("text", F.lit("")).cast("binary")
    return bpe.decode(ids, model).select(
        "doc_id", "lang", "source", "ids", F.size("ids").cast("bigint").alias("n_tokens"),
        (F.col("decoded") == text).alias("intact"),
    )


STAGES = [
    ("toxicity", toxic_documents),
    ("line_dedup", repeated_lines),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark_leaks),
    ("byte_bpe", token_ids),
]

#: Scores and digests of trained models and tokenizers are beyond SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
