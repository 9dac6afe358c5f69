"""Small helpers that the operators share: narrow inputs, tables in the shared folder, sizes."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Where there is no cluster to name a shared folder, as in tests.
LOCAL_DIR = "file:/tmp/checkpoints"
#: Bytes of text that a task takes at a time.
SLICE_BYTES = 4 << 20


def narrow(docs: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names: other columns can't clash with what it adds."""
    return docs.select(*[docs[f"`{name}`"].alias(own) for own, name in columns.items()])


def scratch_path(spark: SparkSession, what: str) -> str:
    """A new folder's path below the folder that the driver and all executors share."""
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{CHECKPOINT_DIR} must name a folder that the driver and all executors share")
        base = LOCAL_DIR
    return f"{base.rstrip('/')}/{what}-{uuid.uuid4().hex}"


def kept_table(df: DataFrame, what: str) -> DataFrame:
    """The frame written as a table to the shared folder and read back: its lineage ends there, and any executor may be lost."""
    path = scratch_path(df.sparkSession, what)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def total_bytes(docs: DataFrame, text: str) -> int:
    """Bytes of all texts."""
    return docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("n")).first()["n"]


def slices(batches: Iterator[pa.RecordBatch], text: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut between rows, so that a slice holds few bytes of text unless one text alone is longer."""
    for batch in batches:
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0).to_pylist()
        start = held = 0
        for i, n in enumerate(lengths):
            if held and held + n > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < len(lengths):
            yield batch.slice(start)


def words_of(text: str | Column) -> Column:
    """Words between ASCII white space as an array; none for null."""
    column = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.coalesce(column, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
