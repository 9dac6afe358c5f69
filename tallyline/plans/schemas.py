"""Declared schemas of the landed feeds and of the tables made from them.

Fixed values throughout: names, order, types and nullability are part of the data contract.
An ``!`` marks a column that must not be null.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

TYPES = {
    "string": StringType(), "double": DoubleType(), "int": IntegerType(), "long": LongType(), "date": DateType(),
    "boolean": BooleanType(),
}


def declare(text: str) -> StructType:
    """``"name type!, name type"`` to a schema. (Spark's own parser of such text needs a session, which imports have not.)"""
    fields = []
    for part in text.split(","):
        name, kind = part.split()
        fields.append(StructField(name, TYPES[kind.rstrip("!")], nullable=not kind.endswith("!")))
    return StructType(fields)


PRICES_RAW = declare(
    "Ticker string!, Date string!, Open double!, High double!, Low double!, Close double!, AdjClose double, "
    "Volume double, Dividends double, StockSplits double, CapitalGains double, ymd string"
)
PRICES = declare(
    "ticker string!, price_date string!, vl_open double!, vl_high double!, vl_low double!, vl_close double!, "
    "vl_adj_close double, vl_volume double, vl_dividends double, vl_splits double, vl_capital_gains double, ymd string"
)
STATEMENT_RAW = declare("Period string!, Ticker string!, Description string!, Date string!, Value double!, ymd string")
BALANCE = declare(
    "balance_period string!, ticker string!, balance_description string!, balance_report_date date!, "
    "balance_value double!, ymd string"
)
INCOME = declare(
    "income_period string!, ticker string!, income_description string!, income_report_date date!, "
    "income_value double!, ymd string"
)
FINANCIAL_EVENT = declare(
    "event_period string!, ticker string!, event_description string!, event_report_date date!, "
    "event_value double!, ymd string, event_type string!"
)
XML_RATES_RAW = declare("typeRate string!, effectiveDate string!, percentRate string!, ymd string")
JSON_RATES_RAW = declare("tipo string!, data string!, valor string!, ymd string")
RATES = declare("rate_type string!, rate_date date!, rate_value double!, ymd string")
TICKERS_RAW = declare(
    "_id string!, Type string!, Ticker string!, Name string, Exchange string, Category_Name string, Country string, "
    "ymd string"
)
TICKERS = declare(
    "ticker_id string!, ticker_type string!, ticker string!, ticker_name string, ticker_exchange string, "
    "ticker_category string, ticker_country string, ymd string"
)
PROFILE_RAW = declare(
    "uuid string!, ticker string!, quoteType string!, city string!, state string!, zip string!, country string!, "
    "phone string!, website string!, industrykey string!, industry string!, sectorkey string!, sector string!, "
    "longBusinessSummary string!, fullTimeEmployees int!, currency string!, payoutRatio double!, marketCap double!, "
    "enterpriseValue long!, floatShares double!, sharesOutstanding long!, shortName string!, longName string!, "
    "timeZoneFullName string!, ymd string"
)
PROFILE = declare(
    "id_profile string!, ticker string!, ticker_type string!, city string!, state string!, zip string!, "
    "country string!, phone string!, website string!, industrykey string!, industry string!, sectorkey string!, "
    "sector string!, business_summary string!, employees int!, currency string!, payout_ratio double!, "
    "market_cap double!, enterprise_value long!, shares_float double!, shares_outstanding long!, "
    "short_name string!, long_name string!, time_Zone string!, ymd string"
)
