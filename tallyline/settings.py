"""What the library reads from the session it is given."""

from __future__ import annotations

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession, fallback: str) -> str:
    """Folder for staged tables: the cluster's shared checkpoint folder if it names one."""
    return spark.conf.get(CHECKPOINT_DIR, None) or fallback


def scratch_dir(spark: SparkSession) -> str:
    """A shared folder for tables that belong to no place of their own. Without a cluster's shared folder there is one on a
    single machine only."""
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named or spark.sparkContext.master.startswith("local"):
        return named or "file:/tmp/checkpoints"
    raise ValueError(f"{CHECKPOINT_DIR} must name a folder that the driver and all executors share")
