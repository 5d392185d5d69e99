"""Calendar expressions. Each takes a date column and returns a column."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescast import schema as S


def lenient_date(text: Column, pattern: str = "yyyy-MM-dd") -> Column:
    """ISO text to date; anything else becomes null instead of failing the job.

    A time of day behind the date, after a space or a ``T``, is left out.
    """
    return F.try_to_date(F.regexp_replace(text, r"^\s*(\d{4}-\d{2}-\d{2})[T ]\d{2}:\d{2}.*$", "$1"), pattern)


def month_start(date: Column) -> Column:
    return F.trunc(date, "MM")


def holiday_flag(date: Column) -> Column:
    return F.date_format(date, "MM-dd").isin(*S.HOLIDAYS).cast("int")


def seasonal_index(date: Column) -> Column:
    """Annual swing of plus and minus ten percent over the day of the year."""
    return 1 + 0.1 * F.sin(F.dayofyear(date) / 365 * 2 * math.pi)


def popularity_multiplier(score: Column) -> Column:
    return 0.8 + score / 100 * 0.4


def with_calendar(df: DataFrame, date: str = "sale_date") -> DataFrame:
    d = F.col(date)
    return df.withColumns({
        "month": F.month(d),
        "week": F.weekofyear(d),
        "month_start": month_start(d),
        "is_holiday": holiday_flag(d),
        "seasonal_index": seasonal_index(d),
    })


def days_after(date: Column, days: int) -> Column:
    """Array of the ``days`` calendar days that follow ``date``."""
    return F.sequence(F.date_add(date, 1), F.date_add(date, days))
