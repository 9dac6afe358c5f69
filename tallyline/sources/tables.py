"""Reading the tables of a layered warehouse."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyline.functions.dates import as_date

# Fixed value: the first day loaded when a table is still empty.
LOAD_START = date(2013, 1, 1)


def table_path(root: str, tier: str, table: str, folder: str | None = None) -> str:
    """``root/tier/table[/folder]``."""
    return "/".join([root.rstrip("/"), tier.lower(), table.lower()] + ([folder] if folder else []))


def read_table(
    spark: SparkSession,
    path: str,
    condition: Column | str | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """Rows of a table that meet a condition; partitions and row groups are pruned by it.

    Without a schema, one is merged from the file footers, since partitions written before a
    column was added lack it. A declared schema saves that pass over the files.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", True)
    df = reader.parquet(path)
    return df if condition is None else df.where(condition)


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
    except AnalysisException:  # no such path, or nothing written there yet
        return False
    return True


def empty_table(spark: SparkSession, schema: StructType | str) -> DataFrame:
    return spark.createDataFrame([], schema)


def find(df: DataFrame, condition: Column | str | None = None, limit: int = 0, order: list[str] | None = None) -> DataFrame:
    """Rows that meet a condition, in ``order``: all of them, or the first ``limit`` if that is above zero.

    A limit needs an order, as without one it would be chance which rows it leaves out.
    """
    if limit and not order:
        raise ValueError("a limit needs an order")
    rows = df if condition is None else df.where(condition)
    if order:
        rows = rows.orderBy(*order)
    return rows.limit(limit) if limit else rows


def or_latest_partition(rows: DataFrame, earlier: DataFrame, partition: str = "ymd") -> DataFrame:
    """The rows, or the newest partition of an earlier table when there are none.

    Both tests are scalar subqueries of the plan, so nothing runs until the result is used,
    and the newest partition is the only one of the earlier table that passes.
    """
    none_new = rows.limit(1).agg(F.count(F.lit(1)) == 0).scalar()
    newest = earlier.agg(F.max(partition)).scalar()
    return rows.unionByName(
        earlier.where((F.col(partition) == newest) & none_new).select(*rows.columns)
    )


def high_water_mark(table: DataFrame, date_column: str, default: date | str = LOAD_START) -> DataFrame:
    """One row, one column: the last date loaded, or the default for an empty table."""
    return table.agg(F.coalesce(F.max(date_column), as_date(default)).alias("high_water_mark"))


def since(feed: DataFrame, date_column: str, mark: DataFrame) -> DataFrame:
    """The part of a feed dated on or after a high-water mark."""
    return feed.where(F.col(date_column) >= mark.scalar())
