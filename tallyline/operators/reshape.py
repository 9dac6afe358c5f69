"""Renaming, and turning wide frames into long ones. Nothing here shuffles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def rename_by_position(df: DataFrame, source: StructType, target: StructType) -> DataFrame:
    """Select the source schema's columns under the target schema's names, pairwise.

    Fields beyond the shorter schema are dropped; values keep their type.
    """
    return df.select([F.col(s.name).alias(t.name) for s, t in zip(source.fields, target.fields)])


def unpivot_prices(
    wide: DataFrame,
    tickers: Sequence[str],
    fields: Mapping[str, str],
    date: str = "Date",
    ticker: str = "Ticker",
    separator: str = "__",
) -> DataFrame:
    """One row per date with ``ticker__field`` columns, to one row per (date, ticker).

    ``fields`` maps each field of the feed to its output name. A field no ticker has is an
    error; a field some ticker lacks is null for that ticker; a (date, ticker) without any
    value gives no row. All tickers of a date leave in one pass over the wide row, so no
    regrouping is needed.
    """
    present = set(wide.columns)
    for field in fields:
        if not any(f"{t}{separator}{field}" in present for t in tickers):
            raise ValueError(f"field {field!r} is not in the feed for any ticker")

    def value(t: str, field: str) -> Column:
        name = f"{t}{separator}{field}"
        return (F.col(f"`{name}`") if name in present else F.lit(None)).cast("double")

    rows = [
        F.struct(F.lit(t).alias(ticker), *[value(t, f).alias(out) for f, out in fields.items()])
        for t in tickers
    ]
    day = F.date_format(date, "yyyy-MM-dd").alias(date)
    return wide.select(day, F.inline(F.array(*rows))).dropna("all", subset=list(fields.values()))


def unpivot_statement(
    wide: DataFrame,
    period: str,
    ticker: str = "Ticker",
    description: str = "Description",
) -> DataFrame:
    """A statement with one column per report date, to (Period, Ticker, Description, Date, Value).

    Empty cells give no row. A cell that is text and not a number gives a row with a null value.
    """
    dates = [c for c in wide.columns if c not in (ticker, description)]
    return (
        wide.unpivot([ticker, description], dates, "Date", "Value")
        .where(F.col("Value").isNotNull())
        .select(
            F.lit(period).alias("Period"),
            F.col(ticker).alias("Ticker"),
            F.col(description).alias("Description"),
            "Date",
            F.col("Value").try_cast("double").alias("Value"),
        )
    )
