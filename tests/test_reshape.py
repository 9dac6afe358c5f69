from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tallyline.operators.reshape import rename_by_position, unpivot_prices, unpivot_statement
from tallyline.plans.schemas import declare

FIELDS = {"Open": "Open", "Adj Close": "AdjClose"}


def test_rename_pairs_by_position_and_keeps_types(spark):
    df = spark.createDataFrame([("x", "2024-01-01", 1.0)], "a string, b string, c double")
    out = rename_by_position(df, df.schema, declare("n string, d date"))
    assert out.columns == ["n", "d"] and out.schema["d"].dataType.simpleString() == "string"


def test_prices_to_long(spark, rows):
    wide = spark.createDataFrame(
        [(date(2024, 1, 2), 1.0, 2.0, None), (date(2024, 1, 3), None, None, 5.0)],
        "Date date, `A.x__Open` double, `A.x__Adj Close` double, B__Open double",
    )
    long = unpivot_prices(wide, ["A.x", "B"], FIELDS)
    assert rows(long) == [("2024-01-02", "A.x", 1.0, 2.0), ("2024-01-03", "B", 5.0, None)]
    assert long.columns == ["Date", "Ticker", "Open", "AdjClose"]


def test_unmapped_price_field_is_an_error(spark):
    wide = spark.createDataFrame([(date(2024, 1, 2), 1.0)], "Date date, A__Open double")
    with pytest.raises(ValueError, match="Adj Close"):
        unpivot_prices(wide, ["A"], FIELDS)


def test_prices_round_trip(spark, rows):
    long = spark.createDataFrame(
        [("2024-01-02", "A", 1.0, 2.0), ("2024-01-02", "B", 3.0, None), ("2024-01-03", "B", 4.0, 5.0)],
        "Date string, Ticker string, Open double, AdjClose double",
    )
    wide = long.groupBy("Date").pivot("Ticker", ["A", "B"]).agg(F.first("Open").alias("Open"), F.first("AdjClose").alias("Adj Close"))
    wide = wide.withColumnsRenamed({f"{t}_{f}": f"{t}__{f}" for t in "AB" for f in FIELDS}).withColumn("Date", F.col("Date").cast("date"))
    assert rows(unpivot_prices(wide, ["A", "B"], FIELDS)) == rows(long)


def test_statement_drops_empty_cells_and_keeps_unreadable_ones(spark, rows):
    wide = spark.createDataFrame(
        [("A", "Revenue", "10", None), ("A", "Tax", "n/a", "2.5")],
        "Ticker string, Description string, `2023-12-31` string, `2022-12-31` string",
    )
    long = unpivot_statement(wide, "Annual")
    assert long.columns == ["Period", "Ticker", "Description", "Date", "Value"]
    assert rows(long) == [
        ("Annual", "A", "Revenue", "2023-12-31", 10.0),
        ("Annual", "A", "Tax", "2022-12-31", 2.5),
        ("Annual", "A", "Tax", "2023-12-31", None),
    ]


def test_reshapes_do_not_shuffle(spark):
    wide = spark.range(10).select(F.current_date().alias("Date"), F.lit(1.0).alias("A__Open"), F.lit(1.0).alias("A__Adj Close"))
    plan = unpivot_prices(wide, ["A"], FIELDS)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
