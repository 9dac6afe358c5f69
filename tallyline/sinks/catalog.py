"""Tables by name: external Parquet tables in Spark's catalog, kept in step with what is written to them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession
from pyspark.sql.types import IntegerType, StructField, StructType

from tallyline.sinks.tables import Commit, open_table

YEARS = StructType([StructField("dt_year", IntegerType())])
#: Partitions that one statement adds.
PER_STATEMENT = 500


def register_tables(
    spark: SparkSession, database: str, locations: Mapping[str, str], layouts: Mapping[str, Sequence[str]] | None = None
) -> None:
    """Creates a table over each location that is not registered yet, and finds its partitions and the columns it has got since.

    ``layouts`` names the partition columns of tables: they are text then (whole years are numbers). Without them Spark
    guesses their types from the folders' names.
    """
    for table, location in locations.items():
        name, columns, layout = f"`{database}`.`{table}`", "", ""
        found = None
        if layouts and table in layouts:
            found = open_table(spark, location, layouts[table][-1], like=YEARS).schema
            columns = "(" + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found) + ")"
            layout = "PARTITIONED BY (" + ", ".join(f"`{c}`" for c in layouts[table]) + ")"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} {columns} USING parquet {layout} LOCATION {text(location)}")
        _add_columns(spark, database, table, [(f.name, f.dataType.simpleString()) for f in found or []])
        if _partitions(spark, database, table):
            spark.catalog.recoverPartitions(f"{database}.{table}")


def follow(spark: SparkSession, database: str, table: str, commit: Commit, layout: Sequence[str] = ()) -> None:
    """Brings a registered table up to a commit: its new columns, and the partitions that are new to it, by name instead of by
    listing all folders. A table that is not registered yet is.

    The commit must say its partitions (``note_partitions``); they are as many as folders that the write has made.
    """
    if not spark.catalog.tableExists(f"{database}.{table}"):
        return register_tables(spark, database, {table: commit.path}, {table: list(layout)} if layout else None)
    _add_columns(spark, database, table, commit.columns)
    known = _partitions(spark, database, table)
    if len(known) > 1:
        spark.catalog.recoverPartitions(f"{database}.{table}")
    elif known:
        specs = [f"PARTITION (`{known[0]}` = {'null' if value is None else text(value)})" for value in commit.partitions]
        for at in range(0, len(specs), PER_STATEMENT):
            spark.sql(f"ALTER TABLE `{database}`.`{table}` ADD IF NOT EXISTS {' '.join(specs[at : at + PER_STATEMENT])}")
    spark.catalog.refreshTable(f"{database}.{table}")


def text(value: str) -> str:
    """A value as a SQL text literal; DDL takes no parameters."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _add_columns(spark: SparkSession, database: str, table: str, columns: Sequence[tuple[str, str]]) -> None:
    known = {c.name.lower() for c in spark.catalog.listColumns(f"{database}.{table}")}
    new = ", ".join(f"`{name}` {kind}" for name, kind in columns if name.lower() not in known)
    if new:
        spark.sql(f"ALTER TABLE `{database}`.`{table}` ADD COLUMNS ({new})")


def _partitions(spark: SparkSession, database: str, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(f"{database}.{table}") if c.isPartition]
