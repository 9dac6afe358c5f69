"""Calendar dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions.dates import as_date, calendar_attributes


def calendar_between(spark: SparkSession, first, last) -> DataFrame:
    """One row per day from ``first`` to ``last``, with descriptive attributes."""
    return _calendar(spark.range(1), as_date(first), as_date(last))


def calendar_from(facts: DataFrame, date: str, last, *, whole_years: bool = False) -> DataFrame:
    """One row per day from the first date found in ``facts`` to ``last``.

    ``whole_years`` starts at 1 January of the first year, so that dates moved to the start
    of their month are covered too.
    """
    earliest = F.min(F.col(date).cast("date")).alias("first_day")
    start = F.trunc("first_day", "YEAR") if whole_years else F.col("first_day")
    return _calendar(facts.agg(earliest), start, as_date(last))


def _calendar(one_row: DataFrame, first: Column, last: Column) -> DataFrame:
    every_day = F.sequence(first, last, F.expr("INTERVAL 1 DAY"))
    days = one_row.select(F.explode(every_day).alias("dt_date"))
    attributes = calendar_attributes(F.col("dt_date"))
    return days.select("dt_date", *[c.alias(name) for name, c in attributes.items()])


def join_calendar(facts: DataFrame, calendar: DataFrame, date: str, attributes: list[str]) -> DataFrame:
    """Facts whose date is in the calendar, with the chosen calendar attributes added.

    A calendar is one row per day, so its size does not follow the facts: Spark broadcasts it
    on its own estimate, and beyond that adaptive execution splits a hot date.
    """
    days = calendar.select(F.col("dt_date").alias("_day"), *attributes)
    return facts.join(days, F.col(date) == F.col("_day")).drop("_day")
