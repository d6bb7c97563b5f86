"""Calendar periods as half-open ranges, so that date filters stay plain comparisons.

A comparison of a bare column with a constant reaches the Parquet scan; a function
applied to the column does not.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_date(value: str | dt.date) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value[:10])


def month_start(day: dt.date) -> dt.date:
    return day.replace(day=1)


def shift_months(first: dt.date, months: int) -> dt.date:
    """First day of the month ``months`` away from the month of ``first``."""
    index = first.year * 12 + first.month - 1 + months
    return dt.date(index // 12, index % 12 + 1, 1)


def quarter_range(value: str | dt.date) -> tuple[dt.date, dt.date]:
    day = as_date(value)
    start = dt.date(day.year, day.month - (day.month - 1) % 3, 1)
    return start, shift_months(start, 3)


def year_range(year: int) -> tuple[dt.date, dt.date]:
    return dt.date(year, 1, 1), dt.date(year + 1, 1, 1)


def instant(df: DataFrame, column: str, value: str | dt.date | dt.datetime) -> Column:
    """Constant of the column's own type; the column itself stays uncast."""
    return F.lit(str(value)).cast(df.schema[column].dataType)


def in_range(df: DataFrame, column: str, start, end) -> Column:
    """start <= column < end."""
    return (F.col(column) >= instant(df, column, start)) & (F.col(column) < instant(df, column, end))


def last_day(column: str | Column) -> Column:
    """Last day of the month; NULL gives NULL."""
    return F.last_day(column)
