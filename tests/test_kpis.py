from __future__ import annotations

import statistics
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tallyline.operators import kpis

SCHEMA = "ticker string, price_date date, vl_open double, vl_high double, vl_low double, vl_close double"


def series(spark, closes, ticker="A", start=date(2024, 1, 29)):
    data = [(ticker, start + timedelta(days=i), c, c, c, c) for i, c in enumerate(closes)]
    return spark.createDataFrame(data, SCHEMA)


def by_date(df, *columns):
    return [tuple(r) for r in df.orderBy("ticker", "price_date").select(*columns).collect()]


CLOSES = [10.0, 12.0, 11.0, 15.0, 14.0, 13.0, 20.0, 5.0]


def test_zscore_expands_and_starts_null(spark):
    got = [r[0] for r in by_date(kpis.with_zscore(series(spark, CLOSES)), "z_score")]
    assert got[0] is None
    for i in range(1, len(CLOSES)):
        seen = CLOSES[: i + 1]
        assert got[i] == pytest.approx(round((CLOSES[i] - statistics.mean(seen)) / statistics.stdev(seen), 4))


def test_zscore_of_constant_prices_is_null(spark):
    assert by_date(kpis.with_zscore(series(spark, [7.0] * 4)), "z_score") == [(None,)] * 4


def test_changes_by_day_and_week(spark):
    df = kpis.with_change_week(kpis.with_change_day(series(spark, CLOSES)))
    got = by_date(df, "vl_change_day", "perc_change_day", "vl_change_week", "perc_change_week")
    assert got[0] == (None, None, None, None)
    assert got[1] == (2.0, 20.0, None, None)
    assert got[5] == (-1.0, -7.14, 3.0, 30.0)
    assert got[7] == (-15.0, -75.0, -6.0, -54.55)


def test_month_change_is_since_the_first_close_but_percent_of_the_previous_row(spark):
    # 29, 30, 31 January, then February
    got = by_date(kpis.with_change_month(series(spark, CLOSES)), "vl_change_month", "perc_change_month")
    assert got[:5] == [(0.0, None), (2.0, 20.0), (1.0, 8.33), (0.0, None), (-1.0, -6.67)]
    assert got[5] == (-2.0, -14.29)


def test_moving_averages_hold_one_row_more_than_their_name(spark):
    closes = [float(i) for i in range(1, 231)]
    got = by_date(kpis.with_moving_averages(series(spark, closes)), "vl_moving_avg_20_days", "vl_moving_avg_200_days")
    assert got[0] == (1.0, 1.0)
    assert got[20][0] == 11.0 and got[21][0] == 12.0
    assert got[200][1] == 101.0 and got[229][1] == 130.0


def test_percent_uses_the_rounded_change_and_the_exact_close(spark):
    got = by_date(kpis.daily_kpis(series(spark, [1.004, 1.0])), "vl_close", "vl_change_day", "perc_change_day")
    assert got == [(1.0, None, None), (1.0, 0.0, 0.0)]


def test_zero_previous_close_gives_no_percent(spark):
    assert by_date(kpis.with_change_day(series(spark, [0.0, 3.0])), "vl_change_day", "perc_change_day")[1] == (3.0, None)


def test_tickers_do_not_mix_and_partitioning_does_not_matter(spark):
    both = series(spark, CLOSES).unionByName(series(spark, CLOSES[::-1], "B"))
    want = by_date(kpis.daily_kpis(both), "*")
    assert by_date(kpis.daily_kpis(both.repartition(7)), "*") == want
    alone = by_date(kpis.daily_kpis(series(spark, CLOSES)), "*")
    assert want[: len(CLOSES)] == alone


def test_two_rows_for_one_day_fail(spark):
    twice = series(spark, [1.0]).unionByName(series(spark, [2.0]))
    with pytest.raises(Exception, match="more than one price row for A on 2024-01-29"):
        kpis.daily_kpis(twice).collect()


def test_one_exchange_serves_every_window(spark):
    plan = kpis.daily_kpis(series(spark, CLOSES))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(ticker") == 1


def test_dividends_are_positive_only(spark, rows):
    df = spark.createDataFrame([("A", date(2024, 1, 1), 0.0), ("A", date(2024, 1, 2), 0.5), ("A", date(2024, 1, 3), None)],
                               "ticker string, price_date date, vl_dividends double")
    assert rows(kpis.dividends(df)) == [("A", date(2024, 1, 2), 0.5)]


def test_latest_rows(spark, rows):
    both = series(spark, CLOSES).unionByName(series(spark, [1.0, 2.0], "B"))
    assert rows(kpis.latest_rows(both), "ticker", "vl_close") == [("A", 5.0), ("B", 2.0)]


def test_latest_rows_keep_ties_and_read_their_input_once(spark, rows, tmp_path):
    data = [("A", date(2024, 1, 1), 1), ("A", date(2024, 1, 2), 2), ("A", date(2024, 1, 2), 3), ("B", None, 4), (None, date(2024, 1, 3), 5), (None, date(2024, 1, 1), 6)]
    spark.createDataFrame(data, "ticker string, price_date date, v int").write.parquet(str(tmp_path / "t"))
    last = kpis.latest_rows(spark.read.parquet(str(tmp_path / "t")))
    assert rows(last, "v") == [(2,), (3,), (5,)]
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1 and "WindowGroupLimit [ticker" in plan


def test_empty_input(spark):
    assert kpis.daily_kpis(series(spark, CLOSES).where(F.lit(False))).count() == 0
