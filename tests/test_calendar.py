from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tallyline.operators.calendar import calendar_between, calendar_from, join_calendar


def test_attributes_of_one_day(spark):
    row = calendar_between(spark, date(2024, 3, 5), date(2024, 3, 5)).first().asDict()
    assert row == {
        "dt_date": date(2024, 3, 5), "dt_year": 2024, "dt_year_short": "24", "dt_month": "03", "dt_day": "05",
        "dt_day_of_week": 3, "dt_day_of_week_short": "Tue", "dt_day_of_week_full": "Tuesday", "dt_week_of_year": 10,
        "dt_month_short": "Mar", "dt_month_full": "March", "dt_first_day_of_month": 1, "dt_last_day_of_month": 31,
        "dt_quarter": "1", "dt_quarter_short": "01", "dt_quarter_long": "Q1.24", "dt_semester": 1,
        "dt_semester_desc": "1st Semester", "dt_full_date": "Tue 05, Mar '24", "dt_is_weekend": "No",
        "dt_is_hollyday": "No",
    }


def test_no_gaps_and_no_repeats(spark):
    days = calendar_between(spark, date(1999, 12, 1), date(2004, 3, 1))
    got = days.agg(F.count("*"), F.countDistinct("dt_date"), F.min("dt_date"), F.max("dt_date")).first()
    expected = (date(2004, 3, 1) - date(1999, 12, 1)).days + 1
    assert tuple(got) == (expected, expected, date(1999, 12, 1), date(2004, 3, 1))


def test_holidays_weekends_and_semesters(spark):
    days = calendar_between(spark, date(2023, 1, 1), date(2023, 12, 31))
    holidays = [r.dt_date.strftime("%m-%d") for r in days.where("dt_is_hollyday = 'Yes'").orderBy("dt_date").collect()]
    assert holidays == ["01-01", "05-01", "09-07", "10-12", "11-02", "11-15", "12-25"]
    assert days.where("dt_is_weekend = 'Yes'").count() == 105
    assert days.where("dt_semester = 1").agg(F.max("dt_date")).first()[0] == date(2023, 6, 30)


def test_starts_at_the_first_fact(spark):
    facts = spark.createDataFrame([(date(2024, 2, 27),), (date(2024, 2, 28),)], "d date")
    assert calendar_from(facts, "d", date(2024, 3, 1)).count() == 4
    assert calendar_from(facts, "d", date(2024, 3, 1), whole_years=True).count() == 61


def test_join_keeps_only_days_in_the_calendar(spark, rows):
    facts = spark.createDataFrame([(1, date(2024, 3, 5)), (2, date(2030, 1, 1))], "id int, day date")
    days = calendar_between(spark, date(2024, 3, 1), date(2024, 3, 31))
    assert rows(join_calendar(facts, days, "day", ["dt_quarter_long"])) == [(1, date(2024, 3, 5), "Q1.24")]
