"""Time helpers (FN9–FN11, FLT8)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the purchase-timestamp text layout of the commerce exports.
PURCHASE_TS_FORMAT = "yyyy-MM-dd HH:mm"


def year_of_epoch(seconds: str | Column) -> Column:
    """UTC calendar year of epoch seconds (session time zone must be UTC)."""
    c = F.col(seconds) if isinstance(seconds, str) else seconds
    return F.year(F.timestamp_seconds(c))


def as_timestamp(df: DataFrame, column: str, fmt: str = PURCHASE_TS_FORMAT) -> Column:
    """Timestamp view of ``column``: parsed with ``fmt`` when it is text
    (unparseable -> NULL, never an ANSI error), unchanged when it already is a
    timestamp."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.col(column)
    return F.try_to_timestamp(F.col(column), F.lit(fmt))


def year_range(df: DataFrame, column: str, year: int) -> Column:
    """``year(column) == year`` written as a half-open range so the predicate
    reaches the Parquet scan (sargable) instead of running after it."""
    start, end = _dt.datetime(year, 1, 1), _dt.datetime(year + 1, 1, 1)
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.TimestampNTZType):
        lo = F.lit(start).cast("timestamp_ntz")
        hi = F.lit(end).cast("timestamp_ntz")
    elif isinstance(dtype, T.DateType):
        lo, hi = F.lit(start.date()), F.lit(end.date())
    elif isinstance(dtype, T.TimestampType):
        lo = F.to_timestamp(F.lit(start.isoformat(sep=" ")))
        hi = F.to_timestamp(F.lit(end.isoformat(sep=" ")))
    else:  # text column: parse first, the range then applies to the parsed value
        ts = as_timestamp(df, column)
        return (ts >= F.lit(start)) & (ts < F.lit(end))
    return (F.col(column) >= lo) & (F.col(column) < hi)
