"""Date column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The days (MM-dd) that the calendar marks as holidays, and below the names of its columns.
HOLIDAYS = ["01-01", "05-01", "09-07", "10-12", "11-02", "11-15", "12-25"]


def lenient_date(column: Column | str, pattern: str = "yyyy-MM-dd") -> Column:
    """Date parse that turns text it cannot read into null instead of failing the job."""
    return F.try_to_date(_col(column), pattern)


def invalid_date(column: Column | str, pattern: str = "yyyy-MM-dd") -> Column:
    """True for text that is present but is not a date in the given pattern."""
    return _col(column).isNotNull() & lenient_date(column, pattern).isNull()


def year_month(column: Column | str) -> Column:
    """``yyyy-MM`` text key."""
    return F.date_format(_col(column), "yyyy-MM")


def month_start(column: Column | str) -> Column:
    return F.trunc(_col(column), "MM")


def as_date(value) -> Column:
    """A date literal from a ``datetime.date`` or ISO text; columns pass through."""
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def calendar_attributes(day: Column) -> dict[str, Column]:
    """Descriptive attributes of a day, by output column name."""
    year_short = F.date_format(day, "yy")
    month, month_day = F.date_format(day, "MM"), F.date_format(day, "dd")
    day_of_week = F.dayofweek(day)
    quarter = F.quarter(day).cast("string")
    semester = F.when(F.month(day) < 7, 1).otherwise(2)
    day_short, month_short = F.date_format(day, "E"), F.date_format(day, "MMM")
    return {
        "dt_year": F.year(day),
        "dt_year_short": year_short,
        "dt_month": month,
        "dt_day": month_day,
        "dt_day_of_week": day_of_week,
        "dt_day_of_week_short": day_short,
        "dt_day_of_week_full": F.date_format(day, "EEEE"),
        "dt_week_of_year": F.weekofyear(day),
        "dt_month_short": month_short,
        "dt_month_full": F.date_format(day, "MMMM"),
        "dt_first_day_of_month": F.lit(1),
        "dt_last_day_of_month": F.dayofmonth(F.last_day(day)),
        "dt_quarter": quarter,
        "dt_quarter_short": F.lpad(quarter, 2, "0"),
        "dt_quarter_long": F.concat(F.lit("Q"), quarter, F.lit("."), year_short),
        "dt_semester": semester,
        "dt_semester_desc": F.when(semester == 1, "1st Semester").otherwise("2nd Semester"),
        "dt_full_date": F.format_string("%s %s, %s '%s", day_short, month_day, month_short, year_short),
        "dt_is_weekend": _yes_no(day_of_week.isin(1, 7)),
        "dt_is_hollyday": _yes_no(F.date_format(day, "MM-dd").isin(HOLIDAYS)),
    }


def _yes_no(condition: Column) -> Column:
    return F.when(condition, "Yes").otherwise("No")


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column
