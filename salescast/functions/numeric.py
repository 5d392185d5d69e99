"""Numeric expressions shared by cleaning, evaluation and reports."""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the smallest denominator of a percentage error (double epsilon).
EPSILON = sys.float_info.epsilon


def finite(x: Column) -> Column:
    """NaN and both infinities become null."""
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), None).otherwise(x)


def lenient_double(x: Column) -> Column:
    """Numeric text to double, null where it does not parse or is not finite."""
    return finite(x.try_cast("double"))


def rmse(actual: Column, predicted: Column) -> Column:
    gap = actual - predicted
    return F.sqrt(F.avg(gap * gap))


def mape_pct(actual: Column, predicted: Column) -> Column:
    return F.avg(F.abs(actual - predicted) / F.greatest(F.abs(actual), F.lit(EPSILON))) * 100


def pct_change(change: Column, base: Column) -> Column:
    """Change as a percentage of its base; null for a zero base."""
    return F.try_divide(change, base) * 100


def direction(change: Column) -> Column:
    """Label of a growth figure. An unknown growth counts as down."""
    return F.when(change > 0, "up").otherwise("down")


def thousands(x: Column) -> Column:
    return F.format_number(x, 0)
