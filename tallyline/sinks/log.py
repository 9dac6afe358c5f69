"""The run log as a table by day, whose small files are merged once a day is over."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.operators.audit import LOG_SCHEMA
from tallyline.sinks.tables import AT_A_TIME, chunks, staging, write_table

DAY = "logged_day"
SCHEMA = f"{LOG_SCHEMA}, {DAY} date"
#: Lists of merged files, in a folder of the table that Spark does not read as part of it.
MERGED = "_merged"


def append_log(row: DataFrame, path: str) -> None:
    write_table(row.withColumn(DAY, F.to_date("logged_at")), path, DAY)


def read_log(spark: SparkSession, path: str) -> DataFrame | None:
    """The log, or None if nothing is there. Each row once, as a merged file and those that it replaces may stand side by side."""
    found = _files(spark, path)
    return None if found is None else found.drop("_file").distinct()


def compact_log(spark: SparkSession, path: str, before: date) -> int:
    """Merges the files of each day before ``before`` into one; returns how many days that were.

    A reader that has listed the files still finds them: what was merged is removed by the next call only. A call that is
    cut short leaves rows twice at worst, which ``read_log`` does not show.
    """
    _remove_merged(spark, path)
    rows = _files(spark, path)
    if rows is None:
        return 0
    with staging(spark, path) as stage:
        past = stage.keep(rows.where(F.col(DAY) < F.lit(before)))
        crowded = past.groupBy(F.col(DAY).alias("_day")).agg(F.count_distinct("_file").alias("n")).where("n > 1")
        merging = stage.keep(past.join(crowded, F.col(DAY) == F.col("_day"), "left_semi"))
        files = stage.keep(merging.select("_file").distinct())
        days = merging.select(DAY).distinct().count()
        if days:
            write_table(merging.drop("_file").distinct(), path, DAY)
            files.write.parquet(f"{path}/{MERGED}/{uuid.uuid4().hex}")
        return days


def _files(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        read = spark.read.schema(SCHEMA).option("ignoreMissingFiles", True).parquet(path)
    except AnalysisException:  # no such path
        return None
    return read.select("*", F.col("_metadata.file_path").alias("_file"))


def _remove_merged(spark: SparkSession, path: str) -> None:
    """Removes the files that an earlier call has merged, some at a time, and then their lists."""
    java, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()
    folder = java.org.apache.hadoop.fs.Path(f"{path}/{MERGED}")
    system = folder.getFileSystem(hadoop)
    if not system.exists(folder):
        return
    for merged in system.listStatus(folder):
        listed = spark.read.schema("_file string").parquet(merged.getPath().toString())
        with ThreadPoolExecutor(AT_A_TIME) as pool:
            for some in chunks(iter(listed.toLocalIterator()), 64 * AT_A_TIME):
                list(pool.map(lambda r: system.delete(java.org.apache.hadoop.fs.Path(java.java.net.URI(r["_file"])), False), some))
        system.delete(merged.getPath(), True)
