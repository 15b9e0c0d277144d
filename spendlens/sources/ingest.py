"""Take over a source log that is always some minutes behind.

Rows reach the source up to a delay after they happened, so a reader that asks only
for what is newer than it has seen loses rows. Each round reads again from the
high-water mark less the delay, drops the calls it already holds there, and appends the
rest. The mark moves last: a round that dies is read again and drops what it had
appended.
"""

from __future__ import annotations

import json
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from spendlens.functions.time import EVENT_DATE, literal_like, parse_as_of
from spendlens.sources.files import Files, read_numbered
from spendlens.sources.logs import write_log

#: How late a call may reach its source log.
LOG_DELAY = timedelta(minutes=45)

_MARKS = "_marks"
_WHO = "_who"


def _identity(df: DataFrame, key: str) -> Column:
    """The key of a call; a call without one is known by its whole row."""
    row = F.sha2(F.to_json(F.struct(*[F.col(c) for c in df.columns])), 256)
    return F.coalesce(F.concat(F.lit("key:"), F.col(key).cast("string")), F.concat(F.lit("row:"), row))


def high_water(spark, path: str) -> datetime | None:
    """Time of the newest call taken over so far."""
    folder = f"{path.rstrip('/')}/{_MARKS}"
    numbers = Files(spark, path).numbers(folder)
    if not numbers:
        return None
    mark = json.loads(read_numbered(spark, folder, numbers[-1]))["mark"]
    return None if mark is None else datetime.fromisoformat(mark)


def _since(df: DataFrame, time_col: str, bound: datetime | None) -> DataFrame:
    """Rows after ``bound`` and those without a time, which may be new at any moment."""
    if bound is None:
        return df
    time = F.col(time_col)
    keep = time.isNull() | (time >= literal_like(bound, df.schema[time_col].dataType))
    if EVENT_DATE in df.columns:
        keep &= F.col(EVENT_DATE).isNull() | (F.col(EVENT_DATE) >= literal_like(bound, T.DateType()))
    return df.where(keep)


def _held(source: DataFrame, path: str) -> DataFrame:
    fields = [f for f in source.schema if f.name != EVENT_DATE]
    schema = T.StructType([*fields, T.StructField(EVENT_DATE, T.DateType())])
    try:
        return source.sparkSession.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return source.sparkSession.createDataFrame([], schema)


def ingest(
    source: DataFrame,
    path: str,
    time_col: str,
    key: str = "query_id",
    delay: timedelta = LOG_DELAY,
    as_of: str | date | datetime | None = None,
) -> datetime | None:
    """Append to the stored log at ``path`` what ``source`` has that it lacks; the new mark.

    Rows of one ``key`` are one call, the earliest counts; rows without a key are one
    call where they are equal in all columns. Calls up to ``delay`` older than the
    newest one taken over are still found, and calls without a time whenever they
    come. With ``as_of`` later calls wait for a later round, so a wrong clock in
    the source cannot push the mark ahead.

    Both sides are read from the mark less the delay on: the source by a filter that
    reaches its scan, the log by its date folders.
    """
    spark, path = source.sparkSession, path.rstrip("/")
    source = source.drop(EVENT_DATE)
    mark = high_water(spark, path)
    bound = None if mark is None else mark - delay
    rows = _since(source, time_col, bound)
    if as_of is not None:
        until = literal_like(parse_as_of(as_of), source.schema[time_col].dataType)
        rows = rows.where(F.col(time_col).isNull() | (F.col(time_col) <= until))
    names = source.columns
    first = F.min_by(
        F.struct(*names), F.struct(F.col(time_col).isNull(), F.col(time_col), F.to_json(F.struct(*names)))
    )
    new = rows.withColumn(_WHO, _identity(source, key)).groupBy(_WHO).agg(first.alias("_row"))
    held = _since(_held(source, path), time_col, bound)
    known = held.select(_identity(source, key).alias(_WHO))
    write_log(new.join(known, _WHO, "left_anti").select("_row.*"), path, time_col)
    newest = _since(_held(source, path), time_col, bound).agg(F.max(F.col(time_col)).cast("string").alias("t")).first()["t"]
    newest = None if newest is None else datetime.fromisoformat(newest)
    found = max([t for t in (mark, newest) if t is not None], default=None)
    files = Files(spark, path)
    number = max(files.numbers(f"{path}/{_MARKS}"), default=-1) + 1
    files.put(f"{path}/{_MARKS}", number, json.dumps({"mark": found and found.isoformat(sep=" ")}))
    return found
