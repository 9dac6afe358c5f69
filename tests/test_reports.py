from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tallyline.operators.calendar import calendar_between
from tallyline.plans import reports


@pytest.fixture(scope="module")
def calendar(spark):
    return calendar_between(spark, date(2013, 1, 1), date(2024, 12, 31))


def test_calls_counted_by_hand(spark):
    """51: 6 + 5 = 11; 62: 6 + 2 + 1 + 4 = 13; 73: 5 + 2 + 1 = 8; 99 is in no phone book."""
    phones = spark.createDataFrame([("Rui", 51), ("Ines", 62), ("Tomas", 73)], ["name", "phone_number"])
    data = [(1, 51, 62, 6), (2, 73, 51, 5), (3, 62, 73, 2), (4, 62, 73, 1), (5, 62, 99, 4)]
    calls = spark.createDataFrame(data, ["id", "caller", "callee", "duration"])
    assert [r.name for r in reports.call_report(phones, calls).collect()] == ["Ines", "Rui"]


def test_calls_with_one_number_in_a_third_of_them(spark):
    calls = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("caller"), (F.col("id") + 1).alias("callee"), F.lit(1).alias("duration")
    )
    phones = spark.range(3001).select(F.concat(F.lit("n"), "id").alias("name"), F.col("id").alias("phone_number"))
    assert [r.name for r in reports.call_report(phones, calls, 1000).collect()] == ["n0"]


def test_a_person_with_two_entries_counts_twice(spark):
    phones = spark.createDataFrame([("A", 1), ("A", 1)], "name string, phone_number long")
    calls = spark.createDataFrame([(1, 1, 2, 5)], "id long, caller long, callee long, duration long")
    assert [r.name for r in reports.call_report(phones, calls, 10).collect()] == ["A"]


def test_dividends(spark):
    data = [("A", date(2013, 5, 1), 9.0), ("A", date(2014, 5, 1), 1.00004), ("A", date(2014, 8, 1), 1.0), ("A", date(2015, 5, 1), 3.0), ("B", date(2015, 1, 1), 2.0)]
    got = reports.dividend_report(spark.createDataFrame(data, "ticker string, ex_date date, vl_dividends double"))
    assert sorted(tuple(r) for r in got.collect()) == [
        ("A", 2014, 2.0, None, None), ("A", 2015, 3.0, 2.0, 50.0), ("B", 2015, 2.0, None, None),
    ]


def statement(spark, kind, data):
    return spark.createDataFrame(data, f"{kind}_period string, ticker string, {kind}_description string, {kind}_report_date date, {kind}_value double")


def test_income(spark, calendar):
    income = statement(spark, "income", [
        ("Annual", "A", "Net Income", date(2023, 12, 31), 25.0), ("Annual", "A", "Total Revenue", date(2023, 12, 31), 200.0),
        ("Quarter", "A", "Net Income", date(2023, 6, 30), 1.0), ("Quarter", "A", "Total Revenue", date(2023, 6, 30), 0.0),
        ("Quarter", "A", "Tax", date(2023, 6, 30), 9.0),
    ])
    got = [tuple(r) for r in reports.income_report(income, calendar).collect()]
    assert got == [
        ("A", "Annual", "2023", "2023", 25.0, 200.0, 12.5), ("A", "Quarter", "20232", "Q2.23", 1.0, 0.0, None),
    ]
    assert reports.income_report(income, calendar, period="Quarterly", ticker="A").count() == 1


def test_balance(spark, calendar):
    lines = [("Annual", "A", "Total Assets", date(2023, 12, 31), 80.0), ("Annual", "A", "Total Liabilities Net Minority Interest", date(2023, 12, 31), 20.0)]
    row = reports.balance_report(statement(spark, "balance", lines), calendar).first()
    assert (row.Total_Assets, row.Total_Liabilities, row.Debt_to_Assets) == (80.0, 20.0, 25.0)


def test_price_report(spark, calendar):
    prices = spark.createDataFrame(
        [("A", date(2024, 3, 5), 1.0, 2.0, 0.1), ("A", date(2024, 3, 28), 3.0, 4.0, 0.2), ("A", date(2013, 3, 28), 9.0, 9.0, 9.0), ("B", date(2024, 3, 6), 5.0, 6.0, 0.3)],
        "ticker string, price_date date, vl_open double, vl_close double, vl_moving_avg_200_days double",
    )
    income = statement(spark, "income", [
        ("Quarter", "A", "Net Income", date(2024, 3, 31), 7.0), ("Quarter", "A", "Net Income", date(2024, 3, 31), 7.0),
        ("Annual", "A", "Net Income", date(2024, 3, 31), 8.0),
    ])
    got = [tuple(r) for r in reports.price_report(prices, calendar, income, date(2024, 4, 1), "Quarterly").collect()]
    assert got == [("A", "2024-03", 1.0, 4.0, 0.2, 7.0), ("B", "2024-03", 5.0, 6.0, 0.3, None)]


def test_rates(spark, calendar, rows):
    data = [("SELIC", date(2013, 12, 31), 1.0), ("SELIC", date(2014, 1, 1), 2.0), ("EFFR", date(2024, 1, 1), 3.0), ("EFFR", date(2030, 1, 1), 4.0), ("OTHER", date(2024, 1, 1), 5.0)]
    rates = spark.createDataFrame(data, "rate_type string, rate_date date, rate_value double")
    assert rows(reports.rates_report(rates, calendar), "rate_value") == [(2.0,), (3.0,)]
