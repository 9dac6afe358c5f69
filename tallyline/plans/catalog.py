"""Catalog: a database of external Parquet tables over the serving tier."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tallyline.operators.scd2 import CURRENT
from tallyline.plans.loads import PARTITIONS
from tallyline.sinks.catalog import follow, register_tables, text
from tallyline.sources.tables import table_exists, table_path

__all__ = [
    "LAYOUTS", "SERVING_TABLES", "create_database", "follow", "register_rate_views", "register_serving", "register_tables", "show_databases",
    "show_tables",
]

# The tables reports read by name.
SERVING_TABLES = [
    "calendar", "tickers", "prices", "prices_month", "dividends", "interest_rate", "financial_event",
    "income", "balance", "profile",
]
LAYOUTS = {t: [PARTITIONS[t]] for t in SERVING_TABLES} | {"profile": [CURRENT, PARTITIONS["profile"]]}


def create_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
    spark.sql(f"USE `{name}`")


def register_serving(spark: SparkSession, database: str, root: str, tier: str = "serving") -> None:
    """Registers every table that reports read by name and that has been written."""
    locations = {t: table_path(root, tier, t) for t in SERVING_TABLES}
    written = {t: path for t, path in locations.items() if table_exists(spark, path)}
    register_tables(spark, database, written, {t: LAYOUTS[t] for t in written})


def register_rate_views(spark: SparkSession, database: str, rate_types: Sequence[str]) -> None:
    """One view per rate type, named after it, over the table of all rates."""
    for rate_type in rate_types:
        spark.sql(
            f"CREATE OR REPLACE VIEW `{database}`.`{rate_type.lower()}` AS "
            f"SELECT * FROM `{database}`.interest_rate WHERE rate_type = {text(rate_type)}"
        )


def show_databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def show_tables(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN `{database}`")
