from __future__ import annotations

from datetime import date

import pytest

from tallyline.operators.summary import month_kpis, month_summary

SCHEMA = ("ticker string, price_date date, vl_open double, vl_high double, vl_low double, vl_close double, "
          "vl_volume double, vl_moving_avg_200_days double")  # fmt: skip


def test_first_and_last_follow_the_date(spark):
    df = spark.createDataFrame(
        [
            ("A", date(2024, 1, 31), 3.0, 9.0, 2.0, 8.0, 5.0, 0.3),
            ("A", date(2024, 1, 2), 1.0, 4.0, 1.0, 2.0, 7.0, 0.1),
            ("A", date(2024, 2, 1), 6.0, 6.0, 6.0, 6.0, 1.0, 0.4),
        ],
        SCHEMA,
    )
    got = [tuple(r) for r in month_summary(df.repartition(3)).orderBy("dt_month").collect()]
    assert got[0] == ("A", 2024, 1, date(2024, 1, 31), 1.0, 1.0, 9.0, 8.0, 12.0, 0.3)
    assert got[1] == ("A", 2024, 2, date(2024, 2, 1), 6.0, 6.0, 6.0, 6.0, 1.0, 0.4)


def months(spark, closes):
    data = [("A", date(2020 + i // 12, i % 12 + 1, 28), c) for i, c in enumerate(closes)]
    return spark.createDataFrame(data, "ticker string, price_date date, vl_close double")


def test_first_month_and_first_year(spark):
    got = month_kpis(months(spark, [float(10 + i) for i in range(14)])).orderBy("price_date").collect()
    first = got[0]
    assert (first.z_score, first.vl_previous_month, first.vl_change_month, first.perc_change_month) == (0.0, 10.0, 0.0, 0.0)
    assert (first.vl_previous_year, first.vl_change_year, first.perc_change_year) == (0.0, 10.0, 0.0)
    assert (got[1].vl_change_month, got[1].perc_change_month) == (1.0, 10.0)
    assert (got[11].vl_change_year, got[11].perc_change_year) == (21.0, 0.0)
    assert (got[12].vl_previous_year, got[12].vl_change_year, got[12].perc_change_year) == (10.0, 12.0, 120.0)


def test_constant_months_have_no_zscore_after_the_first(spark):
    got = month_kpis(months(spark, [5.0, 5.0])).orderBy("price_date").collect()
    assert [r.z_score for r in got] == [0.0, None]


def test_missing_month_counts_rows_not_months(spark):
    df = months(spark, [float(i) for i in range(1, 15)]).where("price_date <> DATE '2020-06-28'")
    last = month_kpis(df).orderBy("price_date").collect()[-1]
    assert last.vl_close == 14.0 and last.vl_previous_year == 1.0


@pytest.mark.parametrize("operator", ["min_by", "max_by"])
def test_months_combine_before_the_shuffle(spark, operator):
    df = spark.createDataFrame([], SCHEMA)
    plan = month_summary(df.repartition(2))._jdf.queryExecution().executedPlan().toString()
    assert f"partial_{operator}" in plan and "SortAggregate" not in plan
