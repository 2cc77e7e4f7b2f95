"""Time expressions in whole seconds and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def seconds(ts: str | Column) -> Column:
    """Whole seconds since the epoch; fractions are cut off."""
    return F.unix_timestamp(F.date_trunc("second", _column(ts)))


def within_days(ts: str | Column, first: str, last: str) -> Column:
    """``first`` <= day of ``ts`` <= ``last``, written so that it reaches the file scan."""
    column = _column(ts)
    after = F.date_add(F.lit(last).cast("date"), 1).cast("timestamp_ntz")
    return (column >= F.lit(first).cast("timestamp_ntz")) & (column < after)


def iso_day(text: str | Column, pattern: str) -> Column:
    """Text in the given date pattern as ``yyyy-MM-dd``; unreadable text becomes null."""
    read = F.try_to_timestamp(F.trim(_column(text)), F.lit(pattern))
    return F.date_format(read, "yyyy-MM-dd")


def year_month(ts: str | Column) -> Column:
    """Calendar month as ``2024_1``."""
    day = F.to_date(_column(ts))
    return F.concat_ws("_", F.year(day).cast("string"), F.month(day).cast("string"))
