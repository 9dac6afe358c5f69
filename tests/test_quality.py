from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tallyline.operators import quality
from tallyline.plans.schemas import declare

SCHEMA = declare("k long!, name string!, v double")


def frame(spark, data):
    return spark.createDataFrame(data, "k long, name string, v double")


def test_a_good_table_passes(spark):
    good = frame(spark, [(1, "a", 0.0), (2, "b", None)])
    assert quality.require_quality(good, SCHEMA) == {
        "check_header": True, "has_negatives": False, "has_nulls": False, "check_dtypes": True, "is_valid": True,
    }


@pytest.mark.parametrize(
    "row, fault", [((1, "a", -1.0), "has_negatives"), ((-1, "a", 1.0), "has_negatives"), ((1, None, 1.0), "has_nulls")]
)
def test_a_bad_row_is_found(spark, row, fault):
    bad = frame(spark, [(1, "a", 1.0), row])
    assert quality.quality_report(bad, SCHEMA).first()[fault] is True
    with pytest.raises(quality.DataQualityError, match=fault):
        quality.require_quality(bad, SCHEMA)


def test_header_and_types(spark):
    missing = frame(spark, [(1, "a", 1.0)]).drop("v")
    assert not quality.quality_report(missing, SCHEMA).first().is_valid
    typed = frame(spark, [(1, "a", 1.0)]).withColumn("v", F.col("v").cast("string"))
    report = quality.quality_report(typed, SCHEMA).first()
    assert report.check_header and not report.check_dtypes and not report.is_valid
    assert quality.same_schema(spark.createDataFrame([(1, "a", 1.0)], SCHEMA), SCHEMA)
    assert not quality.same_schema(missing, SCHEMA)


def test_empty_table_passes(spark):
    assert quality.quality_report(frame(spark, []), SCHEMA).first().is_valid


def test_counts(spark, rows):
    df = frame(spark, [(1, None, -1.0), (2, "b", None), (None, "c", -2.0)])
    assert rows(quality.negative_counts(df, ["k", "v"])) == [("k", 0), ("v", 2)]
    assert rows(quality.null_counts(df, ["k", "name", "v"])) == [("k", 1), ("name", 1), ("v", 1)]


def test_all_counts_take_one_pass(spark, tmp_path):
    path = str(tmp_path / "t")
    frame(spark, [(1, "a", 1.0)]).write.parquet(path)
    plan = quality.quality_report(spark.read.parquet(path), SCHEMA)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_dates(spark, rows):
    df = spark.createDataFrame([("2024-02-29", "x"), ("2023-02-29", None), (None, "01/02/2024")], "a string, b string")
    got = rows(quality.invalid_date_counts(df, {"a": "yyyy-MM-dd", "b": "dd/MM/yyyy"}))
    assert got == [("a", 1), ("b", 1)]


def test_orphans_range_and_timestamps(spark, rows):
    df = spark.createDataFrame([(1, date(1999, 12, 31)), (2, date(2000, 1, 1)), (None, None)], "k int, d date")
    known = spark.createDataFrame([(1,), (1,), (7,)], "id int")
    assert rows(quality.orphans(df, known, "k", "id"), "k") == [(None,), (2,)]
    assert rows(quality.out_of_range(df, "k", 2, 9), "k") == [(1,)]
    assert rows(quality.stale_timestamps(df, "d"), "k") == [(1,)]


def test_outliers(spark, rows):
    df = spark.createDataFrame([(i, 10.0) for i in range(30)] + [(99, 100.0), (98, -100.0)], "k int, v double")
    scored = quality.with_table_zscore(df, "v")
    assert rows(quality.outliers(scored), "k") == [(99,)]
    assert "NestedLoop" not in scored._jdf.queryExecution().executedPlan().toString()
