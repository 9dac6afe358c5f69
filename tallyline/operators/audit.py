"""Run log: one audit row per step of a load, and the newest state of each step."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The columns of the log and the states of a step.
LOG_SCHEMA = (
    "run_id string, tier string, table_name string, location string, status string, source_type string, source_path string, "
    "source_entity string, total_records_source long, inserted long, updated long, deleted long, reprocessed boolean, "
    "message string, started_at timestamp, logged_at timestamp, elapsed_seconds double"
)
STARTED, DONE, FAILED = "started", "done", "failed"


def log_row(
    spark: SparkSession,
    run_id: str,
    tier: str,
    table: str,
    started_at: datetime,
    logged_at: datetime,
    *,
    status: str = DONE,
    location: str | None = None,
    source: tuple[str | None, str | None, str | None] = (None, None, None),
    source_rows: int | None = None,
    metrics: dict[str, int] | None = None,
    reprocessed: bool = False,
    message: str | None = None,
) -> DataFrame:
    """One row to append to the run log. ``source`` is the source's type, path and entity."""
    counts = metrics or {}
    changed = [counts.get(kind) for kind in ("inserted", "updated", "deleted")]
    elapsed = (logged_at - started_at).total_seconds()
    row = (run_id, tier, table, location, status, *source, source_rows, *changed, reprocessed, message, started_at, logged_at, elapsed)
    return spark.createDataFrame([row], LOG_SCHEMA)


def latest_log(log: DataFrame, keys: list[str], at: str, tiebreak: list[str]) -> DataFrame:
    """The newest row of each key. Rows combine before the shuffle, one per key and task."""
    rest = [c for c in log.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(at, *tiebreak)).alias("_row")
    return log.groupBy(*keys).agg(newest).select(*keys, "_row.*")
