"""Data quality checks. All counts of a table are taken in one pass over it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, NumericType, StringType, StructType

from tallyline.functions.dates import as_date, invalid_date
from tallyline.functions.numbers import lenient_double


class DataQualityError(Exception):
    """Raised by ``require_quality`` when a table fails its checks."""


def header_ok(df: DataFrame, schema: StructType) -> bool:
    """True if every column of the schema is there."""
    return set(schema.fieldNames()) <= set(df.columns)


def types_ok(df: DataFrame, schema: StructType) -> bool:
    """True if every column of the schema that is there has the declared type."""
    found = {f.name: f.dataType for f in df.schema}
    return all(found[f.name] == f.dataType for f in schema if f.name in found)


def same_schema(df: DataFrame, schema: StructType) -> bool:
    """True if names, types and nullability are the expected ones, in order."""
    return df.schema == schema


def negative_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows below zero, per column: (column_name, bad_rows)."""
    return _counts(df, {c: F.col(c) < 0 for c in columns})


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null rows, per column: (column_name, bad_rows)."""
    return _counts(df, {c: F.col(c).isNull() for c in columns})


def invalid_date_counts(df: DataFrame, patterns: Mapping[str, str]) -> DataFrame:
    """Rows whose text is no date of the column's pattern, per column: (column_name, bad_rows)."""
    return _counts(df, {c: invalid_date(c, p) for c, p in patterns.items()})


def quality_report(df: DataFrame, schema: StructType) -> DataFrame:
    """One row: check_header, has_negatives, has_nulls, check_dtypes and the verdict is_valid.

    Negatives are looked for in double and long columns, nulls in the non-nullable ones. A
    number that came as text is read leniently here; its type is what fails the table.
    """
    present = [f for f in schema if f.name in df.columns]
    numbers = [f.name for f in present if isinstance(f.dataType, (DoubleType, LongType))]
    readable = [n for n in numbers if isinstance(df.schema[n].dataType, (NumericType, StringType))]
    negative = [lenient_double(n) < 0 for n in readable]
    null = [F.col(f.name).isNull() for f in present if not f.nullable]
    verdict = F.col("check_header") & ~F.col("has_negatives") & ~F.col("has_nulls") & F.col("check_dtypes")
    return df.agg(
        F.lit(header_ok(df, schema)).alias("check_header"),
        _any_row(negative).alias("has_negatives"),
        _any_row(null).alias("has_nulls"),
        F.lit(types_ok(df, schema)).alias("check_dtypes"),
    ).withColumn("is_valid", verdict)


def require_quality(df: DataFrame, schema: StructType) -> dict[str, bool]:
    """Runs the report and raises if the table is not valid."""
    result = quality_report(df, schema).first().asDict()
    if not result["is_valid"]:
        raise DataQualityError(f"data quality check failed: {result}")
    return result


def orphans(df: DataFrame, reference: DataFrame, column: str, reference_column: str) -> DataFrame:
    """Rows whose value is not in the reference column; a null value is an orphan.

    The reference is reduced to distinct values first, so its repeats are not shuffled.
    """
    known = reference.select(F.col(reference_column).alias("_known")).distinct()
    return df.join(known, F.col(column) == F.col("_known"), "left_anti")


def out_of_range(df: DataFrame, column: str, low, high) -> DataFrame:
    """Rows outside [low, high]."""
    return df.where((F.col(column) < low) | (F.col(column) > high))


def stale_timestamps(df: DataFrame, column: str, earliest="2000-01-01") -> DataFrame:
    """Rows dated before the earliest plausible date; null is no fault here."""
    return df.where(F.col(column).isNotNull() & (F.col(column) < as_date(earliest)))


def outliers(df: DataFrame, score: str = "z_score", limit: float = 3.0) -> DataFrame:
    """Rows whose standard score is above the limit (one-sided)."""
    return df.where(F.col(score) > limit)


def with_table_zscore(df: DataFrame, column: str, score: str = "z_score") -> DataFrame:
    """Standard score against the whole table's mean and deviation.

    Two scalars from a map-side combined aggregate, in place of a window over one partition.
    """
    mean = df.agg(F.avg(column)).scalar()
    deviation = df.agg(F.stddev(column)).scalar()
    return df.withColumn(score, F.round(F.try_divide(F.col(column) - mean, deviation), 4))


def _any_row(conditions: Sequence[Column]) -> Column:
    hits = [F.count_if(c) for c in conditions]
    total = hits[0] if hits else F.lit(0)
    for hit in hits[1:]:
        total = total + hit
    return total > 0


def _counts(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    one_row = df.agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])
    pairs = [F.struct(F.lit(n).alias("column_name"), F.col(f"`{n}`").alias("bad_rows")) for n in conditions]
    return one_row.select(F.inline(F.array(*pairs)))
