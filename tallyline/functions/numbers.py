"""Numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(part: Column, base: Column, digits: int = 2) -> Column:
    """``100 * part / base`` rounded half up; null where the base is zero or null."""
    return F.round(F.try_divide(100 * part, base), digits)


def lenient_double(column: Column | str) -> Column:
    """Number parse that turns text it cannot read into null instead of failing the job."""
    return _col(column).try_cast("double")


def zscore(value: Column, mean: Column, deviation: Column, digits: int = 4) -> Column:
    """Standard score; null where the deviation is zero or undefined."""
    return F.round(F.try_divide(value - mean, deviation), digits)


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column
