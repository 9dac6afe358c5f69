"""Interest rates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.functions.dates import lenient_date, month_start
from tallyline.functions.numbers import lenient_double


def clean_rates(
    raw: DataFrame,
    rate_type: str,
    date: str,
    value: str,
    pattern: str = "yyyy-MM-dd",
    keep: tuple[str, ...] = ("ymd",),
) -> DataFrame:
    """Text rates to (rate_type, rate_date date, rate_value double); bad text becomes null.

    Columns in ``keep`` are passed on.
    """
    return raw.select(
        F.col(rate_type).alias("rate_type"),
        lenient_date(date, pattern).alias("rate_date"),
        lenient_double(value).alias("rate_value"),
        *[c for c in keep if c in raw.columns],
    )


def rejected_rates(
    raw: DataFrame, rate_type: str, date: str, value: str, pattern: str = "yyyy-MM-dd", keep: tuple[str, ...] = ("ymd",)
) -> DataFrame:
    """The rates that ``clean_rates`` can't read, as they came, with the reason; ``usable_rates`` are the others.

    A payload that could not be parsed arrives as a row without a date and a value, and is among them.
    """
    texts = [F.col(c).cast("string") for c in (rate_type, date, value)]
    reason = (
        F.when(texts[1].isNull() & texts[2].isNull(), "payload")
        .when(texts[0].isNull(), "type")
        .when(lenient_date(date, pattern).isNull(), "date")
        .when(lenient_double(value).isNull(), "value")
    )
    named = [t.alias(n) for t, n in zip(texts, ("rate_type", "rate_date", "rate_value"), strict=True)]
    return raw.select(*named, *[c for c in keep if c in raw.columns], reason.alias("reason")).where("reason IS NOT NULL")


def usable_rates(rates: DataFrame) -> DataFrame:
    """Cleaned rates with a type, a date and a value."""
    return rates.dropna("any", subset=["rate_type", "rate_date", "rate_value"])


def month_rates(rates: DataFrame, sequence: str | None = None) -> DataFrame:
    """The last rate of each month, dated the first of that month.

    ``sequence`` orders several rates of one day. Days are reduced first: both steps keep a
    fixed-width buffer per group and combine before the shuffle, so neither the number of
    rows of a type nor that of a day matters.
    """
    daily = rates
    if sequence is not None:
        daily = rates.groupBy("rate_type", "rate_date").agg(F.max_by("rate_value", sequence).alias("rate_value"))
    return (
        daily.groupBy("rate_type", month_start("rate_date").alias("_month"))
        .agg(F.max_by("rate_value", "rate_date").alias("rate_value"))
        .select("rate_type", F.col("_month").alias("rate_date"), "rate_value")
    )
