"""Stored logs: partitioned by event date, appended day by day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from spendlens.functions.time import EVENT_DATE, literal_like, parse_as_of
from spendlens.plans.rollup import hourly_rollup
from spendlens.schema import TABLES, conform

#: Sources ``read_log`` takes, as Spark names them.
FORMATS = ("parquet", "orc", "json", "csv")


def read_log(
    spark: SparkSession, path: str, table: str | None = None, fmt: str = "parquet", **options
) -> DataFrame:
    """Read a log, conformed to a canonical table when one is named.

    Text formats are read with the canonical schema, never an inferred one.
    """
    if fmt not in FORMATS:
        raise ValueError(f"format {fmt!r} is not one of {', '.join(FORMATS)}")
    reader = spark.read.format(fmt).options(**options)
    if table is not None and fmt in ("json", "csv"):
        reader = reader.schema(TABLES[table])
    df = reader.load(path)
    return df if table is None else conform(df, table)


def read_table(spark: SparkSession, name: str, table: str) -> DataFrame:
    """Read a catalog table or view, conformed to a canonical table."""
    return conform(spark.read.table(name), table)


def write_log(
    df: DataFrame, path: str, time_col: str, *, mode: str = "append", fmt: str = "parquet"
) -> None:
    """Store a log under ``event_date=...`` folders, so time windows prune files.

    The rebalance hint lets Spark cut a large day into several files and put a
    small day into one, by the sizes it sees while writing; sorting by time
    inside each file gives tight min/max statistics for the window filter.
    """
    dated = df if EVENT_DATE in df.columns else df.withColumn(EVENT_DATE, F.to_date(time_col))
    (
        dated.hint("rebalance", EVENT_DATE)
        .sortWithinPartitions(EVENT_DATE, time_col)
        .write.mode(mode)
        .partitionBy(EVENT_DATE)
        .format(fmt)
        .save(path)
    )


def refresh_rollup(
    log: DataFrame, path: str, time_col: str, credit_col: str, *, since: str | None = None
) -> None:
    """Write the hourly rollup, replacing only the days it covers.

    ``since`` limits the work to days from that date on. Whole days are
    rewritten, so running it twice changes nothing.
    """
    if since is not None:
        first = literal_like(parse_as_of(since), log.schema[time_col].dataType)
        log = log.where(F.col(time_col) >= first)
        if EVENT_DATE in log.columns:
            log = log.where(F.col(EVENT_DATE) >= F.lit(since).cast("date"))
    (
        hourly_rollup(log, time_col, credit_col)
        .hint("rebalance", EVENT_DATE)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(EVENT_DATE)
        .parquet(path)
    )


def read_ledger(spark: SparkSession, path: str, schema) -> DataFrame:
    """Keys already processed; empty before the first run."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def append_ledger(rows: DataFrame, path: str, key: str) -> None:
    """Add the keys of processed rows to the ledger."""
    rows.select(key).distinct().write.mode("append").parquet(path)
