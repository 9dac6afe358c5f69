"""Daily indicators of a price series.

A series holds one row per (ticker, day): that is the key the price table is merged on, and
``checked_series`` fails the job when it does not hold. So the rows of one ticker are bounded
by the number of days in the calendar however much data the prices were built from, and a
window over one ticker is bounded too. All windows share one exchange on the ticker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions.numbers import percent, zscore

# Rows before the current one in the two moving averages, by output column.
MOVING_AVERAGES = {"vl_moving_avg_20_days": 20, "vl_moving_avg_200_days": 200}
ROWS_PER_WEEK = 5


class Series:
    """The columns that make up a price series, and the windows over them."""

    def __init__(self, ticker: str = "ticker", date: str = "price_date", close: str = "vl_close"):
        self.ticker, self.date, self.close = ticker, date, close

    @property
    def value(self) -> Column:
        return F.col(self.close)

    @property
    def by_date(self):
        return Window.partitionBy(self.ticker).orderBy(self.date)

    @property
    def so_far(self):
        return self.by_date.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    @property
    def in_month(self):
        return Window.partitionBy(self.ticker, F.trunc(self.date, "MM")).orderBy(self.date)

    def before(self, rows: int) -> Column:
        return F.lag(self.close, rows).over(self.by_date)


PRICES = Series()


def checked_series(prices: DataFrame, s: Series = PRICES) -> DataFrame:
    """The same rows, dated by dates; fails at run time on a second row for one ticker and day.

    The check rides on the close, which every indicator reads, and looks one row back in the
    windows' own order: it costs no further sort or shuffle.
    """
    dated = prices.withColumn(s.date, F.col(s.date).cast("date"))
    repeated = F.lag(s.date).over(s.by_date) == F.col(s.date)
    message = F.concat(
        F.lit("more than one price row for "), F.col(s.ticker), F.lit(" on "), F.col(s.date).cast("string")
    )
    return dated.withColumn(s.close, F.when(repeated, F.raise_error(message).cast("double")).otherwise(s.value))


def with_zscore(prices: DataFrame, s: Series = PRICES) -> DataFrame:
    """Standard score of the close against every close up to the same day."""
    mean, deviation = F.avg(s.close).over(s.so_far), F.stddev(s.close).over(s.so_far)
    return prices.withColumn("z_score", zscore(s.value, mean, deviation))


def with_change_day(prices: DataFrame, s: Series = PRICES) -> DataFrame:
    """Change against the previous row, in value and percent."""
    return _with_change(prices, "day", s.before(1), s.before(1), s)


def with_change_week(prices: DataFrame, s: Series = PRICES) -> DataFrame:
    """Change against the row five rows back, in value and percent."""
    return _with_change(prices, "week", s.before(ROWS_PER_WEEK), s.before(ROWS_PER_WEEK), s)


def with_change_month(prices: DataFrame, s: Series = PRICES) -> DataFrame:
    """Change since the month's first close; the percent is of the previous row in the month."""
    first_close = F.first(s.close).over(s.in_month)
    previous = F.lag(s.close, 1).over(s.in_month)
    return _with_change(prices, "month", first_close, previous, s)


def with_moving_averages(prices: DataFrame, s: Series = PRICES) -> DataFrame:
    """Mean close over the current row and the 20 (and 200) rows before it."""
    means = {
        name: F.round(F.avg(s.close).over(s.by_date.rowsBetween(-rows, 0)), 2)
        for name, rows in MOVING_AVERAGES.items()
    }
    return prices.withColumns(means)


def daily_kpis(prices: DataFrame, s: Series = PRICES) -> DataFrame:
    """Every daily indicator, computed from the exact close; prices are rounded last.

    The month's windows come last: the others share one sort, they need their own.
    """
    series = checked_series(prices, s)
    for step in (with_zscore, with_change_day, with_change_week, with_moving_averages, with_change_month):
        series = step(series, s)
    rounded = ["vl_open", "vl_high", "vl_low", s.close]
    return series.withColumns({c: F.round(c, 2) for c in rounded if c in prices.columns})


def kpis_of_feed(series: DataFrame, fed: DataFrame, s: Series = PRICES) -> DataFrame:
    """Indicators of the days in a feed (``fed``: ticker and day), computed over all that ``series`` has of the feed's tickers,
    so that a short feed gets the values of a long one."""
    tickers, days = fed.select(s.ticker).distinct(), fed.select(s.ticker, F.col(s.date).cast("date").alias(s.date)).distinct()
    return daily_kpis(series.join(tickers, s.ticker, "left_semi"), s).join(days, [s.ticker, s.date], "left_semi")


def from_first_fed(rows: DataFrame, fed: DataFrame, s: Series = PRICES) -> DataFrame:
    """The rows that a feed (``fed``: ticker and day) may change: of each of its tickers those from the earliest fed day on, as
    indicators of later days read earlier ones."""
    firsts = fed.groupBy(F.col(s.ticker).alias("_fed")).agg(F.min(F.col(s.date).cast("date")).alias("_first"))
    own = [F.col(f"`{c}`") for c in rows.columns]
    return rows.join(firsts, (F.col(s.ticker) == F.col("_fed")) & (F.col(s.date).cast("date") >= F.col("_first"))).select(*own)


def kpis_since_feed(series: DataFrame, fed: DataFrame, s: Series = PRICES) -> DataFrame:
    """Indicators of all days that a feed changes, over all that ``series``, which has the feed, holds of its tickers."""
    tickers = fed.select(s.ticker).distinct()
    return from_first_fed(daily_kpis(series.join(tickers, s.ticker, "left_semi"), s), fed, s)


def dividends(prices: DataFrame) -> DataFrame:
    """Days on which a dividend was paid."""
    return prices.where(F.col("vl_dividends") > 0).select(
        "ticker", F.col("price_date").alias("ex_date"), "vl_dividends"
    )


def latest_rows(df: DataFrame, key: str = "ticker", date: str = "price_date") -> DataFrame:
    """The rows that carry their key's last date, all of them if several do. The input is read once: a task keeps what is first
    by date among its own rows of a key, and only that is shuffled."""
    newest = F.rank().over(Window.partitionBy(key).orderBy(F.desc(date)))
    return df.where(F.col(date).isNotNull()).withColumn("_rank", newest).where("_rank = 1").drop("_rank")


def _with_change(prices: DataFrame, period: str, base: Column, percent_base: Column, s: Series) -> DataFrame:
    value, share = f"vl_change_{period}", f"perc_change_{period}"
    based = prices.withColumns({"_base": base, "_percent_base": percent_base})
    return (
        based.withColumn(value, F.round(s.value - F.col("_base"), 2))
        .withColumn(share, percent(F.col(value), F.col("_percent_base")))
        .drop("_base", "_percent_base")
    )
