"""Monthly roll-up of a price series, and its indicators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions.numbers import percent, zscore

MONTHS_PER_YEAR = 12


def month_summary(prices: DataFrame) -> DataFrame:
    """Open, low, high, close and volume per (ticker, year, month).

    First and last follow the price date, not the order rows happen to arrive in. Every
    aggregate has a fixed-width buffer, so days combine before the shuffle.
    """
    day = "price_date"
    return prices.groupBy("ticker", F.year(day).alias("dt_year"), F.month(day).alias("dt_month")).agg(
        F.max(day).alias("price_date"),
        F.round(F.min_by("vl_open", day), 2).alias("vl_open"),
        F.round(F.min("vl_low"), 2).alias("vl_low"),
        F.round(F.max("vl_high"), 2).alias("vl_high"),
        F.round(F.max_by("vl_close", day), 2).alias("vl_close"),
        F.sum("vl_volume").alias("vl_volume"),
        F.round(F.max_by("vl_moving_avg_200_days", day), 2).alias("vl_moving_avg_200_days"),
    )


def month_kpis(months: DataFrame) -> DataFrame:
    """Standard score and changes against the previous month and the row a year (12 rows) back.

    A first month is compared with itself. Within the first 12 months the base of the year
    change is zero, so the change is the close and its percent is zero.
    """
    by_date = Window.partitionBy("ticker").orderBy("price_date")
    so_far = by_date.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    close = F.col("vl_close")
    deviation = F.stddev("vl_close").over(so_far)
    previous = F.when(F.row_number().over(by_date) == 1, close).otherwise(F.lag("vl_close").over(by_date))
    based = months.withColumns(
        {
            "z_score": F.when(deviation.isNull(), F.lit(0.0)).otherwise(
                zscore(close, F.avg("vl_close").over(so_far), deviation)
            ),
            "vl_previous_month": previous,
            "vl_previous_year": F.lag("vl_close", MONTHS_PER_YEAR, 0.0).over(by_date),
        }
    )
    year_base = F.col("vl_previous_year")
    return (
        based.withColumn("vl_change_month", F.round(close - F.col("vl_previous_month"), 2))
        .withColumn("perc_change_month", percent(F.col("vl_change_month"), F.col("vl_previous_month")))
        .withColumn("vl_change_year", F.round(close - year_base, 2))
        .withColumn(
            "perc_change_year",
            F.when(year_base == 0, F.lit(0.0)).otherwise(percent(F.col("vl_change_year"), year_base)),
        )
    )
