import pytest
from pyspark.sql import functions as F

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs(spark):
    """Documents from (id, text) pairs, with the other columns and a clashing one."""

    def build(*rows):
        full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        made = spark.createDataFrame(full, DOCS)
        return made.withColumn("Score", F.lit("mine")).withColumn("_key", F.lit(1)).withColumn("_quality", F.lit(1)).withColumn("_ID", F.lit(3)).withColumn("h", F.lit(2))

    return build
