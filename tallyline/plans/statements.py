"""Financial statements as one table of events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyline.operators.reshape import rename_by_position, unpivot_statement
from tallyline.plans.schemas import FINANCIAL_EVENT, STATEMENT_RAW


def raw_statement(annual: DataFrame, quarterly: DataFrame, ymd: str) -> DataFrame:
    """Annual and quarterly wide statements as one long frame, tagged with the load day."""
    long = unpivot_statement(annual, "Annual").unionByName(unpivot_statement(quarterly, "Quarter"))
    return long.withColumn("ymd", F.lit(ymd))


def clean_statement(raw: DataFrame, schema: StructType) -> DataFrame:
    """The raw statement under a statement table's names, with the report date as a date."""
    report_date = next(f.name for f in schema if f.name.endswith("report_date"))
    renamed = rename_by_position(raw, STATEMENT_RAW, schema)
    return renamed.withColumn(report_date, F.col(report_date).cast("date"))


def as_events(statement: DataFrame, schema: StructType, event_type: str) -> DataFrame:
    """Statement rows as financial events of the given type."""
    return rename_by_position(statement, schema, FINANCIAL_EVENT).withColumn("event_type", F.lit(event_type))
