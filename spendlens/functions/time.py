"""Report windows. Reports never read the clock: the caller passes ``as_of``."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Partition column a stored log may carry (see ``sources.logs``).
EVENT_DATE = "event_date"


def parse_as_of(as_of: str | date | datetime) -> datetime:
    """Normalise ``as_of`` to a naive datetime in the session time zone."""
    if isinstance(as_of, str):
        as_of = datetime.fromisoformat(as_of)
    if not isinstance(as_of, datetime):
        as_of = datetime.combine(as_of, time())
    if as_of.tzinfo is not None:
        raise ValueError("as_of must be naive; it is read in the session time zone")
    return as_of


def month_start(as_of: str | date | datetime, months: int) -> datetime:
    """Start of the first of the ``months`` calendar months that end with that of ``as_of``."""
    until = parse_as_of(as_of)
    year, month = divmod(until.year * 12 + until.month - months, 12)
    return datetime(year, month + 1, 1)


def literal_like(moment: datetime, dtype: T.DataType) -> Column:
    """``moment`` as a foldable literal of the same type as the column it meets.

    Comparing equal types keeps the predicate a plain ``column >= constant``,
    which parquet can push down; a mixed comparison would wrap the column in a
    cast and lose that.
    """
    if isinstance(dtype, T.DateType):
        return F.lit(moment.date().isoformat()).cast("date")
    return F.lit(moment.isoformat(sep=" ")).cast(dtype)


def recent(
    df: DataFrame,
    time_col: str,
    as_of: str | date | datetime,
    *,
    days: float | None = None,
    hours: float | None = None,
    whole_days: bool = False,
    since: datetime | None = None,
) -> DataFrame:
    """Rows of the last ``days``/``hours`` up to ``as_of``, or those from ``since`` on.

    With none of them set all history is kept.

    On a DATE column the start is compared as a timestamp, so a start after
    midnight leaves out its own day; ``whole_days`` compares dates instead.
    When the log carries an ``event_date`` partition column the same bounds are
    repeated on it, so old partitions are never listed or read.
    """
    until = parse_as_of(as_of)
    dtype = df.schema[time_col].dataType
    keep = F.col(time_col) <= literal_like(until, dtype)
    if days is not None or hours is not None:
        since = until - timedelta(days=days or 0, hours=hours or 0)
    if since is not None:
        if whole_days:
            since = datetime.combine(since.date(), time())
        first = since
        if isinstance(dtype, T.DateType) and since.time() != time():
            first = datetime.combine(since.date() + timedelta(days=1), time())
        keep &= F.col(time_col) >= literal_like(first, dtype)
    if EVENT_DATE in df.columns and time_col != EVENT_DATE:
        keep &= F.col(EVENT_DATE) <= literal_like(until, T.DateType())
        if since is not None:
            keep &= F.col(EVENT_DATE) >= literal_like(since, T.DateType())
    return df.where(keep)


def truncated(df: DataFrame, unit: str, time_col: str) -> Column:
    """``date_trunc`` that keeps TIMESTAMP_NTZ as TIMESTAMP_NTZ."""
    return F.date_trunc(unit, F.col(time_col)).cast(df.schema[time_col].dataType)
