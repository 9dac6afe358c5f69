from __future__ import annotations

import os
from datetime import date, datetime

from tallyline.operators.audit import latest_log, log_row
from tallyline.sinks.log import append_log, compact_log, read_log


def test_newest_row_of_each_step_wins(spark, rows):
    start = datetime(2024, 1, 1)
    log = log_row(spark, "r1", "raw", "prices", start, datetime(2024, 1, 1, 0, 1), metrics={"inserted": 3, "updated": 1})
    log = log.unionByName(log_row(spark, "r1", "raw", "prices", start, datetime(2024, 1, 1, 0, 2), metrics={"inserted": 5}))
    log = log.unionByName(log_row(spark, "r1", "serving", "prices", start, datetime(2024, 1, 1, 0, 3), reprocessed=True))
    newest = latest_log(log, ["run_id", "tier", "table_name"], "logged_at", ["inserted"])
    assert rows(newest, "tier", "inserted", "updated", "elapsed_seconds", "reprocessed") == [
        ("raw", 5, None, 120.0, False), ("serving", None, None, 180.0, True),
    ]


def files(path):
    return {f"{d}/{f}" for d in os.listdir(path) if d.startswith("logged_day=") for f in os.listdir(f"{path}/{d}") if f.endswith(".parquet")}


def test_files_of_past_days_are_merged(spark, tmp_path, rows):
    path = str(tmp_path / "log")
    assert read_log(spark, path) is None and compact_log(spark, path, date(2024, 1, 9)) == 0
    for day in (1, 2, 3):
        for minute in range(3):
            append_log(log_row(spark, f"r{day}", "raw", f"t{minute}", datetime(2024, 1, day), datetime(2024, 1, day, 0, minute)), path)
    small, log = files(path), rows(read_log(spark, path), "run_id", "table_name")
    listed = read_log(spark, path)
    assert len(small) == 9 and len(log) == 9
    assert compact_log(spark, path, date(2024, 1, 3)) == 2
    # a reader of before finds its files, a new one each row once
    assert listed.count() == 9 and small < files(path) and rows(read_log(spark, path), "run_id", "table_name") == log
    assert compact_log(spark, path, date(2024, 1, 3)) == 0
    assert sorted(f.split("/")[0][-2:] for f in files(path)) == ["01", "02", "03", "03", "03"]
    assert rows(read_log(spark, path), "run_id", "table_name") == log
