from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tallyline.functions import dates, numbers, predicates


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_percent_is_rounded_half_up_and_null_on_zero_base(spark):
    assert one(spark, numbers.percent(F.lit(1.0), F.lit(8.0))) == 12.5
    assert one(spark, numbers.percent(F.lit(0.125), F.lit(100.0), 2)) == 0.13
    assert one(spark, numbers.percent(F.lit(1.0), F.lit(0.0))) is None
    assert one(spark, numbers.percent(F.lit(1.0), F.lit(None).cast("double"))) is None


def test_zscore_is_null_without_deviation(spark):
    assert one(spark, numbers.zscore(F.lit(3.0), F.lit(1.0), F.lit(2.0))) == 1.0
    assert one(spark, numbers.zscore(F.lit(3.0), F.lit(3.0), F.lit(0.0))) is None


def test_lenient_parses(spark):
    df = spark.createDataFrame([("1.5", "2020-02-29"), ("x", "2021-02-29"), (None, None)], "n string, d string")
    found = df.select(
        numbers.lenient_double("n"), dates.lenient_date("d"), dates.invalid_date("d")
    ).collect()
    assert [tuple(r) for r in found] == [(1.5, date(2020, 2, 29), False), (None, None, True), (None, None, False)]


def test_lenient_date_in_another_pattern(spark):
    assert one(spark, dates.lenient_date(F.lit("05/03/2024"), "dd/MM/yyyy")) == date(2024, 3, 5)


def test_differs_ignores_nulls_unless_null_safe(spark):
    pairs = spark.createDataFrame([(1, "a", "a"), (2, "a", "b"), (3, None, "b"), (4, None, None)], "k int, x string, y string")
    paired = pairs.select("k", F.struct(F.col("x").alias("v")).alias("old"), F.struct(F.col("y").alias("v")).alias("new"))
    plain = paired.where(predicates.differs(["v"])).select("k").collect()
    safe = paired.where(predicates.differs(["v"], null_safe=True)).select("k").collect()
    assert [r.k for r in plain] == [2]
    assert [r.k for r in safe] == [2, 3]


def test_differs_over_no_columns_never_holds(spark):
    assert one(spark, predicates.differs(["k"], exclude=["k"])) is False


def test_reprocess_days():
    assert predicates.reprocess_days(date(2024, 3, 10)) == 5
    assert predicates.reprocess_days(date(2024, 3, 10), date(2024, 2, 29)) == 10


def test_recent_window_includes_its_first_day(spark):
    df = spark.createDataFrame([(date(2024, 3, 4),), (date(2024, 3, 5),)], "d date").select(F.struct("d").alias("old"))
    kept = df.where(predicates.recent("d", date(2024, 3, 10))).select("old.d").collect()
    assert [r.d for r in kept] == [date(2024, 3, 5)]
