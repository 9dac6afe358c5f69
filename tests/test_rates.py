from __future__ import annotations

from datetime import date

from tallyline.operators.rates import clean_rates, month_rates


def test_clean_rates(spark, rows):
    raw = spark.createDataFrame(
        [("SELIC", "05/03/2024", "10.5", "20240306"), ("SELIC", "31/02/2024", "x", "20240306")],
        "tipo string, data string, valor string, ymd string",
    )
    got = rows(clean_rates(raw, "tipo", "data", "valor", "dd/MM/yyyy"))
    assert got == [("SELIC", None, None, "20240306"), ("SELIC", date(2024, 3, 5), 10.5, "20240306")]


def test_month_takes_the_last_rate_of_the_last_day(spark, rows):
    df = spark.createDataFrame(
        [
            ("E", date(2024, 3, 5), 1.0, 1), ("E", date(2024, 3, 20), 2.0, 2), ("E", date(2024, 3, 20), 3.0, 9),
            ("E", date(2024, 4, 1), 4.0, 3), ("S", date(2024, 3, 1), 5.0, 4),
        ],
        "rate_type string, rate_date date, rate_value double, seq int",
    )
    got = rows(month_rates(df, "seq"))
    assert got == [("E", date(2024, 3, 1), 3.0), ("E", date(2024, 4, 1), 4.0), ("S", date(2024, 3, 1), 5.0)]
    one_a_day = df.where("seq <> 2").drop("seq")
    assert rows(month_rates(one_a_day)) == got
