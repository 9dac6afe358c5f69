"""Report queries over the serving tables.

Each answers for every ticker at once; ``ticker`` narrows it to one. Dates relative to
today take ``as_of``, so that a report can be repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions.dates import as_date, year_month
from tallyline.operators.calendar import join_calendar
from tallyline.operators.kpis import latest_rows

# Statement lines and periods as the feeds name them, report defaults, and below the names of the reports' columns.
NET_INCOME, REVENUE = "Net Income", "Total Revenue"
ASSETS, LIABILITIES = "Total Assets", "Total Liabilities Net Minority Interest"
PERIODS = {"Annual": "Annual", "Quarterly": "Quarter"}
PRICE_MONTHS = 120
FIRST_DIVIDEND = FIRST_RATE = "2014-01-01"
CALL_THRESHOLD = 10


def price_report(
    prices: DataFrame,
    calendar: DataFrame,
    income: DataFrame,
    as_of,
    period: str = "Annual",
    months: int = PRICE_MONTHS,
    ticker: str | None = None,
) -> DataFrame:
    """Open, close and long average of each month, with the net income reported in it."""
    recent = F.col("price_date") >= F.add_months(as_date(as_of), -months)
    days = join_calendar(_only(prices, ticker).where(recent), calendar, "price_date", ["dt_year", "dt_month"])
    month = F.concat_ws("-", "dt_year", "dt_month").alias("year_month")
    by_month = days.groupBy("ticker", month).agg(
        F.min_by("vl_open", "price_date").alias("vl_open"),
        F.max_by("vl_close", "price_date").alias("vl_close"),
        F.max_by("vl_moving_avg_200_days", "price_date").alias("vl_moving_avg_200_days"),
    )
    reported = (
        _only(income, ticker)
        .where((F.col("income_description") == NET_INCOME) & (F.col("income_period") == PERIODS.get(period, period)))
        .select("ticker", year_month("income_report_date").alias("year_month"), "income_value")
        .distinct()
    )
    return by_month.join(reported, ["ticker", "year_month"], "left").orderBy("ticker", "year_month")


def dividend_report(dividends: DataFrame, start=FIRST_DIVIDEND, ticker: str | None = None) -> DataFrame:
    """Dividends per year, the previous year's, and growth.

    Growth sets the exact sum against the rounded previous one.
    """
    years = (
        _only(dividends, ticker)
        .where(F.col("ex_date") >= as_date(start))
        .groupBy("ticker", F.year("ex_date").alias("dt_year"))
        .agg(F.sum("vl_dividends").alias("_paid"))
    )
    before = F.round(F.lag("_paid").over(Window.partitionBy("ticker").orderBy("dt_year")), 4)
    paid, previous = F.col("_paid"), F.col("vl_dividend_prev")
    return years.withColumn("vl_dividend_prev", before).select(
        "ticker",
        "dt_year",
        F.round(paid, 4).alias("vl_dividends"),
        "vl_dividend_prev",
        F.round(F.try_divide(paid - previous, previous) * 100, 2).alias("vl_dividend_growth"),
    )


def income_report(income: DataFrame, calendar: DataFrame, period: str | None = None, ticker: str | None = None) -> DataFrame:
    """Net income, revenue and profit margin by period."""
    return _statement_report(
        _only(income, ticker), calendar, "income", period,
        {"Net_Income": NET_INCOME, "Total_Revenue": REVENUE}, "Profit_Margin",
    )


def balance_report(balance: DataFrame, calendar: DataFrame, period: str | None = None, ticker: str | None = None) -> DataFrame:
    """Assets, liabilities and debt to assets by period."""
    return _statement_report(
        _only(balance, ticker), calendar, "balance", period,
        {"Total_Liabilities": LIABILITIES, "Total_Assets": ASSETS}, "Debt_to_Assets",
    )


def _statement_report(
    rows: DataFrame, calendar: DataFrame, prefix: str, period: str | None, lines: dict[str, str], ratio: str
) -> DataFrame:
    """Two statement lines side by side, and the first as percent of the second."""
    description, value, kind = (F.col(f"{prefix}_{c}") for c in ("description", "value", "period"))
    chosen = rows.where(description.isin(list(lines.values())))
    if period is not None:
        chosen = chosen.where(kind == PERIODS.get(period, period))
    dated = join_calendar(chosen, calendar, f"{prefix}_report_date", ["dt_year", "dt_quarter", "dt_quarter_long"])
    year = F.col("dt_year").cast("string")
    by_year = kind == "Annual"
    sums = {name: F.sum(F.when(description == line, value)).alias(name) for name, line in lines.items()}
    part, whole = (F.col(name) for name in lines)
    return (
        dated.groupBy(
            "ticker",
            f"{prefix}_period",
            F.when(by_year, year).otherwise(F.concat(year, "dt_quarter")).alias("dt"),
            F.when(by_year, year).otherwise(F.col("dt_quarter_long")).alias("dt_period"),
        )
        .agg(*sums.values())
        .withColumn(ratio, F.round(F.try_divide(part * 100, whole), 2))
        .orderBy("dt", "ticker", f"{prefix}_period")
    )


# Columns of the latest-day report, from the prices and from the calendar.
LATEST_PRICE_COLUMNS = [
    "ticker", "price_date", "vl_close", "perc_change_day", "perc_change_month", "perc_change_week",
    "vl_change_day", "vl_change_week", "vl_change_month", "vl_moving_avg_200_days",
]
LATEST_CALENDAR_COLUMNS = ["dt_day_of_week_full", "dt_day", "dt_month_full", "dt_year", "dt_full_date"]


def latest_report(prices: DataFrame, calendar: DataFrame, ticker: str | None = None) -> DataFrame:
    """Each ticker's last day: its changes, with calendar labels."""
    last = latest_rows(_only(prices, ticker).select(*LATEST_PRICE_COLUMNS))
    return join_calendar(last, calendar, "price_date", LATEST_CALENDAR_COLUMNS)


def latest_day(latest: DataFrame) -> DataFrame:
    return latest.select("ticker", "dt_full_date", "perc_change_day")


def latest_month(latest: DataFrame) -> DataFrame:
    return latest.select("ticker", "dt_month_full", "perc_change_month")


def latest_against_average(latest: DataFrame) -> DataFrame:
    return latest.select("ticker", "dt_year", "vl_close", "vl_moving_avg_200_days")


def rates_report(
    rates: DataFrame, calendar: DataFrame, start=FIRST_RATE, rate_types: tuple[str, ...] = ("SELIC", "EFFR")
) -> DataFrame:
    """Rates of the chosen types since a date, on calendar days.

    The types live in one table, so their union is one scan with an IN filter.
    """
    chosen = rates.where(F.col("rate_type").isin(*rate_types) & (F.col("rate_date") >= as_date(start)))
    return join_calendar(chosen.select("rate_type", "rate_date", "rate_value"), calendar, "rate_date", [])


def call_report(phones: DataFrame, calls: DataFrame, threshold: Column | float = CALL_THRESHOLD) -> DataFrame:
    """Names whose calls, made and received, add up to the threshold or more.

    Durations are summed per number before the join, so what is shuffled and joined is one
    row per number, however many calls it has.
    """
    made = calls.select(F.col("caller").alias("phone"), "duration")
    received = calls.select(F.col("callee").alias("phone"), "duration")
    per_phone = made.union(received).groupBy("phone").agg(F.sum("duration").alias("duration"))
    return (
        phones.join(per_phone, phones["phone_number"] == per_phone["phone"])
        .groupBy("name", "phone")
        .agg(F.sum("duration").alias("duration"))
        .where(F.col("duration") >= threshold)
        .select("name")
        .orderBy("name")
    )


def _only(df: DataFrame, ticker: str | None) -> DataFrame:
    return df if ticker is None else df.where(F.col("ticker") == ticker)
