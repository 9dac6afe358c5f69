from __future__ import annotations

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyline import settings
from tallyline.operators.scd2 import CURRENT, END
from tallyline.plans import catalog
from tallyline.sinks import tables as sinks
from tallyline.sources.tables import read_table

SCHEMA = "k int, p string, v int"
CHANGED = "old.v <> new.v"


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def files(path, partition):
    folder = f"{path}/p={partition}"
    return {f for f in os.listdir(folder) if f.endswith(".parquet")}


def test_first_write_counts_and_partitions(spark, path, rows):
    commit = sinks.upsert(frame(spark, (1, "a", 1), (2, "b", 2)), path, ["k"], CHANGED, "p")
    assert commit.metrics == {"inserted": 2, "updated": 0, "deleted": 0}
    assert {"p=a", "p=b"} <= set(os.listdir(path))
    assert rows(spark.read.parquet(path), "k", "v", "p") == [(1, 1, "a"), (2, 2, "b")]


def test_first_write_refuses_repeated_keys(spark, path):
    with pytest.raises(Exception, match="more than one source row"):
        sinks.upsert(frame(spark, (1, "a", 1), (1, "b", 2)), path, ["k"])


@pytest.mark.parametrize("partition", ["p", None])
def test_upsert(spark, path, rows, partition):
    sinks.upsert(frame(spark, (1, "a", 1), (2, "b", 2), (3, "c", 3)), path, ["k"], CHANGED, partition)
    commit = sinks.upsert(frame(spark, (2, "b", 9), (3, "c", 3), (4, "d", 4)), path, ["k"], CHANGED, partition)
    assert (commit.inserted, commit.updated) == (1, 1)
    assert rows(spark.read.parquet(path), "k", "p", "v") == [(1, "a", 1), (2, "b", 9), (3, "c", 3), (4, "d", 4)]


def test_only_changed_partitions_are_written(spark, path):
    sinks.upsert(frame(spark, (1, "a", 1), (2, "b", 2), (3, "c", 3)), path, ["k"], CHANGED, "p")
    before = {p: files(path, p) for p in "abc"}
    sinks.upsert(frame(spark, (2, "b", 9), (3, "c", 3)), path, ["k"], CHANGED, "p")
    after = {p: files(path, p) for p in "abc"}
    assert before["a"] == after["a"] and before["c"] == after["c"] and before["b"] != after["b"]


def test_nothing_changed_writes_nothing(spark, path):
    rows_in = frame(spark, (1, "a", 1))
    sinks.upsert(rows_in, path, ["k"], CHANGED, "p")
    before = files(path, "a")
    assert sinks.upsert(rows_in, path, ["k"], CHANGED, "p").metrics == {"inserted": 0, "updated": 0, "deleted": 0}
    assert files(path, "a") == before


def test_a_row_that_moves_leaves_its_partition(spark, path, rows):
    sinks.upsert(frame(spark, (1, "Brand#1 x/y", 1), (2, "b", 2)), path, ["k"], CHANGED, "p")
    sinks.upsert(frame(spark, (1, "b", 7)), path, ["k"], CHANGED, "p")
    assert rows(spark.read.parquet(path), "k", "p", "v") == [(1, "b", 7), (2, "b", 2)]


def test_null_partition_values(spark, path, rows):
    sinks.upsert(frame(spark, (1, None, 1), (2, "b", 2)), path, ["k"], CHANGED, "p")
    sinks.upsert(frame(spark, (1, None, 5), (3, None, 3)), path, ["k"], CHANGED, "p")
    assert rows(spark.read.parquet(path), "k", "p", "v") == [(1, None, 5), (2, "b", 2), (3, None, 3)]


def test_partition_values_keep_their_type(spark, path, rows):
    sinks.upsert(frame(spark, (1, "20240101", 1)), path, ["k"], CHANGED, "p")
    sinks.upsert(frame(spark, (2, "20240102", 2)), path, ["k"], CHANGED, "p")
    assert rows(spark.read.schema(SCHEMA).parquet(path), "k", "p") == [(1, "20240101"), (2, "20240102")]


def test_new_column(spark, path, rows):
    sinks.upsert(frame(spark, (1, "a", 1), (2, "b", 2)), path, ["k"], CHANGED, "p")
    wider = frame(spark, (2, "b", 9)).withColumn("extra", F.lit("x"))
    sinks.upsert(wider, path, ["k"], CHANGED, "p")
    assert rows(read_table(spark, path), "k", "v", "extra") == [(1, 1, None), (2, 9, "x")]
    sinks.upsert(frame(spark, (1, "a", 8)), path, ["k"], CHANGED, "p")
    assert rows(read_table(spark, path), "k", "v", "extra") == [(1, 8, None), (2, 9, "x")]


def staged_tables(spark, path):
    """Folders of staged tables, in the shared folder the session names if it does."""
    root = settings.shared_dir(spark, f"{path}__staging")
    return {f"{root}/{d}" for d in os.listdir(root) if d.startswith("staged-")} if os.path.isdir(root) else set()


def test_staged_rows_are_removed_once_published_and_a_failed_write_can_be_repeated(spark, path, monkeypatch):
    sinks.upsert(frame(spark, (1, "a", 1)), path, ["k"], CHANGED, "p")
    before = staged_tables(spark, path)
    sinks.upsert(frame(spark, (1, "a", 2)), path, ["k"], CHANGED, "p")
    assert staged_tables(spark, path) == before

    def fail(*_, **__):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(sinks, "_publish", fail)
    with pytest.raises(RuntimeError):
        sinks.upsert(frame(spark, (1, "a", 3)), path, ["k"], CHANGED, "p")
    assert len(staged_tables(spark, path) - before) == 1
    assert spark.read.parquet(path).select("v").first().v == 2
    monkeypatch.undo()
    assert sinks.upsert(frame(spark, (1, "a", 3)), path, ["k"], CHANGED, "p").updated == 1
    assert [r.v for r in spark.read.parquet(path).collect()] == [3]


def test_stages_beside_the_table_when_the_session_names_no_folder(spark, path, monkeypatch):
    monkeypatch.setattr(settings, "CHECKPOINT_DIR", "spark.checkpoint.dir.unset")
    staged = kept_by_stage(monkeypatch)
    sinks.upsert(frame(spark, (1, "a", 1)), path, ["k"], CHANGED, "p")
    assert f"{path}__staging/staged-" in staged[0].inputFiles()[0]


def kept_by_stage(monkeypatch):
    """What is staged from now on, before it is removed."""
    staged, keep = [], sinks._Stage.keep
    monkeypatch.setattr(sinks._Stage, "keep", lambda self, rows: staged.append(keep(self, rows)) or staged[-1])
    monkeypatch.setattr(sinks._Stage, "__exit__", lambda *_: None)
    return staged


def test_one_changed_row_stages_its_partition_alone(spark, path, monkeypatch):
    old = spark.range(10_000).select(F.col("id").cast("int").alias("k"), F.concat(F.lit("p"), F.col("id") % 50).alias("p"), F.lit(1).alias("v"))
    sinks.upsert(old, path, ["k", "p"], CHANGED, "p")
    staged = kept_by_stage(monkeypatch)
    daily = old.withColumn("v", F.when(F.col("k") == 7, 2).otherwise(F.col("v")))
    commit = sinks.upsert(daily, path, ["k", "p"], CHANGED, "p")
    assert (commit.updated, commit.inserted, commit.source) == (1, 0, 10_000)
    assert [t.count() for t in staged] == [10_000, 1, 200]  # the source, what it changes, the changed partition


@pytest.mark.parametrize("n", [400])
def test_many_partitions(spark, path, n):
    """Far more partitions than a driver would like to list: all of them change, then one row leaves each."""
    old = spark.range(2 * n).select(F.col("id").cast("int").alias("k"), F.concat(F.lit("p"), F.col("id") % n).alias("p"), F.lit(1).alias("v"))
    sinks.upsert(old, path, ["k"], CHANGED, "p")
    assert sinks.upsert(old.withColumn("v", F.lit(2)), path, ["k"], CHANGED, "p").updated == 2 * n
    assert sinks.delete(spark, path, f"k < {n}", "p").deleted == n
    assert spark.read.parquet(path).agg(F.count("*"), F.min("v"), F.min("k")).first()[:] == (n, 2, n)


CODES = ["005930", "000660", "1E5", "0x1F", "2024-01-01"]


def test_partition_text_is_never_a_number(spark, path, rows):
    sinks.upsert(frame(spark, *[(i, c, i) for i, c in enumerate(CODES)]), path, ["k"], CHANGED, "p")
    sinks.upsert(frame(spark, (0, CODES[0], 9), (9, CODES[1], 9)), path, ["k"], CHANGED, "p")
    assert sinks.delete(spark, path, "p = '000660' AND k = 1", "p").deleted == 1
    assert sinks.delete(spark, path, "k = 2", "p").deleted == 1
    want = [(0, "005930", 9), (3, "0x1F", 3), (4, "2024-01-01", 4), (9, "000660", 9)]
    assert rows(spark.read.schema(SCHEMA).parquet(path), "k", "p", "v") == want
    assert {d for d in os.listdir(path) if d.startswith("p=")} == {f"p={c}" for c in CODES}


def test_first_write_of_nothing(spark, path, rows):
    assert sinks.upsert(frame(spark).where("v > 0"), path, ["k"], CHANGED, "p").metrics == {"inserted": 0, "updated": 0, "deleted": 0}
    assert sinks.upsert(frame(spark, (1, "a", 1)), path, ["k"], CHANGED, "p").inserted == 1
    assert rows(spark.read.parquet(path), "k", "p", "v") == [(1, "a", 1)]
    assert sinks.delete(spark, f"{path}_none", "true", "p").deleted == 0


def test_one_partition_holding_a_third_of_the_rows(spark, path):
    old = spark.range(9000).select(F.col("id").cast("int").alias("k"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 20)).alias("p"), F.lit(1).alias("v"))
    sinks.upsert(old, path, ["k", "p"], CHANGED, "p")
    commit = sinks.upsert(old.where("p = 'hot'").withColumn("v", F.lit(2)), path, ["k", "p"], CHANGED, "p")
    assert commit.updated == 3000
    assert spark.read.parquet(path).groupBy("v").count().orderBy("v").collect() == [(1, 6000), (2, 3000)]


def test_delete(spark, path, rows):
    sinks.upsert(frame(spark, (1, "a", 1), (2, "a", 2), (3, "b", 3), (4, "c", None)), path, ["k"], CHANGED, "p")
    before = files(path, "c")
    assert sinks.delete(spark, path, "v >= 2", "p").deleted == 2
    assert rows(spark.read.schema(SCHEMA).parquet(path), "k") == [(1,), (4,)]
    assert files(path, "c") == before
    assert sinks.delete(spark, path, "v > 99", "p").deleted == 0


@pytest.mark.parametrize("partition", ["p", None])
def test_update(spark, path, rows, partition):
    sinks.upsert(frame(spark, (1, "a", 1), (2, "a", 2), (3, "b", 3), (4, "c", None), (5, None, 9)), path, ["k"], CHANGED, partition)
    commit = sinks.update(spark, path, "v >= 2", {"v": F.col("v") * 10, "p": F.when(F.col("k") == 3, "new").otherwise(F.col("p"))}, partition)
    assert (commit.source, commit.updated, commit.inserted) == (3, 3, 0)
    got = sinks.open_table(spark, path, partition, like=frame(spark).schema)
    assert rows(got, "k", "p", "v") == [(1, "a", 1), (2, "a", 20), (3, "new", 30), (4, "c", None), (5, None, 90)]
    same = sinks.update(spark, path, F.col("k") < 3, {"p": "a"}, partition)
    assert (same.source, same.updated) == (2, 0)
    nulled = sinks.update(spark, path, "k = 2", {"v": None}, partition)
    assert nulled.updated == 1 and rows(sinks.open_table(spark, path, partition), "k", "v")[1] == (2, None)


def test_update_that_matches_nothing_may_insert(spark, path, rows):
    new = {"k": 7, "p": "x"}
    assert sinks.update(spark, path, "k = 7", {"v": 1}, "p") == sinks.Commit(path)
    assert sinks.update(spark, path, "k = 7", {"v": F.lit(1)}, "p", insert=new).inserted == 1
    assert sinks.update(spark, path, "k = 7", {"v": F.col("v") + 1}, "p", insert=new).metrics == {"inserted": 0, "updated": 1, "deleted": 0}
    assert sinks.update(spark, path, "k = 8", {"v": 5}, "p", insert={"k": 8}).inserted == 1
    wider = sinks.update(spark, path, "k = 8", {"note": F.lit("seen")}, "p")
    assert wider.columns == (("note", "string"),)
    assert rows(read_table(spark, path, schema="k int, p string, v int, note string"), "k", "p", "v", "note") == [(7, "x", 2, None), (8, None, 5, "seen")]
    with pytest.raises(ValueError, match="assignment"):
        sinks.update(spark, path, "k = 8", {}, "p")


def test_update_writes_the_changed_partitions_alone(spark, path):
    sinks.upsert(frame(spark, (1, "a", 1), (2, "b", 2), (3, "c", 3)), path, ["k"], CHANGED, "p")
    before = {p: files(path, p) for p in "abc"}
    sinks.update(spark, path, "k >= 2", {"v": 3}, "p")
    after = {p: files(path, p) for p in "abc"}
    assert before["a"] == after["a"] and before["c"] == after["c"] and before["b"] != after["b"]


def test_emptied_partitions_cost_no_job_each(spark, tmp_path):
    tracker, jobs = spark.sparkContext.statusTracker(), []
    for n in (3, 60):
        path = str(tmp_path / f"t{n}")
        rows_in = spark.range(2 * n).select(F.col("id").cast("int").alias("k"), F.concat(F.lit("p/ "), F.col("id") % n).alias("p"), F.lit(1).alias("v"))
        sinks.upsert(rows_in, path, ["k"], CHANGED, "p")
        spark.sparkContext.setJobGroup(f"empty {n}", "")
        assert sinks.delete(spark, path, "p <> 'p/ 0'", "p").deleted == 2 * n - 2
        jobs.append(len(tracker.getJobIdsForGroup(f"empty {n}")))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert [r.k for r in spark.read.parquet(path).orderBy("k").collect()] == [0, n]
        assert len([d for d in os.listdir(path) if d.startswith("p=")]) == n
    assert jobs[1] < jobs[0] + 12  # listing and the iterator cost a few


def scanned(df):
    """(partitions, files) that the scans of a frame read."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df._jdf.queryExecution().executedPlan()
        df._jdf.collectAsList()
        leaves = [plan.collectLeaves().apply(i) for i in range(plan.collectLeaves().size())]
        scans = [s.metrics() for s in leaves if "FileScan" in s.toString() and s.metrics().contains("numPartitions")]
        return [(m.apply("numPartitions").value(), m.apply("numFiles").value()) for m in scans]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_an_upsert_reads_the_partitions_of_its_source(spark, path, monkeypatch):
    """Keys (ticker, day): of fifty partitions the feed's two; of a table without them the files whose keys can match."""
    old = spark.range(5000).select(F.concat(F.lit("t"), F.col("id") % 50).alias("p"), F.floor(F.col("id") / 50).cast("int").alias("k"), F.lit(1).alias("v"))
    sinks.upsert(old, path, ["p", "k"], CHANGED, "p")
    seen, near = [], sinks._near
    monkeypatch.setattr(sinks, "_near", lambda *a: seen.append(near(*a)) or seen[-1])
    reads = []
    monkeypatch.setattr(sinks, "_counts", lambda taken, counts=sinks._counts: reads.extend(scanned(seen[-1].select("p", "k"))[:1]) or counts(taken))
    feed = frame(spark, (7, "t3", 5), (500, "t40", 5)).select("p", "k", "v")
    commit = sinks.upsert(feed, path, ["p", "k"], CHANGED, "p")
    assert (commit.inserted, commit.updated) == (1, 1) and reads[0] == (2, 2)
    flat = f"{path}_flat"
    old.repartitionByRange(10, "k").write.parquet(flat)
    commit = sinks.upsert(feed, flat, ["k", "p"], CHANGED)
    assert (commit.inserted, commit.updated) == (1, 1)
    assert "GreaterThanOrEqual(k,7)" in seen[-1]._jdf.queryExecution().executedPlan().toString()


def test_versions(spark, path, rows):
    first = frame(spark, (1, "a", 1), (2, "b", 2))
    assert sinks.upsert_versions(first, path, ["k"], datetime(2024, 1, 1), "p").inserted == 2
    second = frame(spark, (1, "c", 5), (2, "b", 2), (3, "c", 3))
    commit = sinks.upsert_versions(second, path, ["k"], datetime(2024, 2, 1), "p")
    assert (commit.inserted, commit.updated) == (2, 1)
    got = rows(sinks.open_table(spark, path, "p"), "k", "p", "v", END, CURRENT)
    assert got == [
        (1, "a", 1, datetime(2024, 1, 31), False), (1, "c", 5, None, True), (2, "b", 2, None, True), (3, "c", 3, None, True),
    ]
    assert sinks.upsert_versions(second, path, ["k"], datetime(2024, 3, 1), "p").metrics["inserted"] == 0
    assert rows(sinks.open_table(spark, path, "p"), "k", "p", "v", END, CURRENT) == got


def test_closed_versions_are_not_written_again(spark, path, rows):
    sinks.upsert_versions(frame(spark, (1, "a", 1), (2, "a", 2), (3, "b", 3)), path, ["k"], datetime(2024, 1, 1), "p")
    sinks.upsert_versions(frame(spark, (1, "a", 5)), path, ["k"], datetime(2024, 2, 1), "p")
    closed = set(os.listdir(f"{path}/is_current=false/p=a"))
    other = set(os.listdir(f"{path}/is_current=true/p=b"))
    wider = frame(spark, (2, "b", 9), (3, "b", 3)).withColumn("extra", F.when(F.col("k") == 2, "x"))
    assert sinks.upsert_versions(wider, path, ["k"], datetime(2024, 3, 1), "p").metrics == {"inserted": 1, "updated": 1, "deleted": 0}
    assert closed < set(os.listdir(f"{path}/is_current=false/p=a"))
    assert other != set(os.listdir(f"{path}/is_current=true/p=b"))
    got = rows(sinks.open_table(spark, path, "p"), "k", "p", "v", "extra", CURRENT)
    assert got == [(1, "a", 1, None, False), (1, "a", 5, None, True), (2, "a", 2, None, False), (2, "b", 9, "x", True), (3, "b", 3, None, True)]


@pytest.mark.parametrize("partition", ["p", None])
@pytest.mark.parametrize("order", [(0, 2, 1), (2, 1, 0), (2, 0, 1)])
def test_snapshots_in_any_order(spark, path, rows, order, partition):
    months = [datetime(2024, m, 1) for m in (1, 2, 3)]
    snapshots = [
        frame(spark, (1, "a", 1), (2, "b", 1), (3, "a", 1), (4, "c", 1)),
        frame(spark, (1, "c", 3), (2, "b", 1), (3, "a", 3)),
        frame(spark, (1, "a", 1), (2, "b", 2), (3, "a", 1), (5, "c", 1)),
    ]
    commits = [sinks.upsert_versions(snapshots[i], path, ["k"], months[i], partition) for i in order]
    ends = [datetime(2024, 1, 31), datetime(2024, 2, 29)]
    want = [
        (1, "a", 1, ends[0], False), (1, "a", 1, None, True), (1, "c", 3, ends[1], False), (2, "b", 1, ends[1], False), (2, "b", 2, None, True),
        (3, "a", 1, ends[0], False), (3, "a", 1, None, True), (3, "a", 3, ends[1], False), (4, "c", 1, None, True), (5, "c", 1, None, True),
    ]
    key = lambda r: [(v is not None, str(v)) for v in r]
    assert rows(sinks.open_table(spark, path, partition), "k", "p", "v", END, CURRENT) == sorted(want, key=key)
    assert commits[-1].source == snapshots[order[-1]].count()
    again = sinks.upsert_versions(snapshots[1], path, ["k"], months[1], partition)
    assert again.metrics == {"inserted": 0, "updated": 0, "deleted": 0}
    assert rows(sinks.open_table(spark, path, partition), "k", "p", "v", END, CURRENT) == sorted(want, key=key)


def test_a_table_without_a_record_refuses_late_snapshots(spark, path):
    import shutil

    for month in (1, 3):
        sinks.upsert_versions(frame(spark, (1, "a", month)), path, ["k"], datetime(2024, month, 1), "p")
    shutil.rmtree(f"{path}__seen")
    with pytest.raises(ValueError, match="older than the last closing"):
        sinks.upsert_versions(frame(spark, (1, "a", 2)), path, ["k"], datetime(2024, 2, 1), "p")


def test_catalog(spark, path, rows):
    sinks.write_table(frame(spark, (1, "a", 1), (2, "b", 2)), path, "p")
    catalog.create_database(spark, "served")
    try:
        catalog.register_tables(spark, "served", {"things": path})
        catalog.register_tables(spark, "served", {"things": path})
        assert "served" in [r[0] for r in catalog.show_databases(spark).collect()]
        assert [r.tableName for r in catalog.show_tables(spark, "served").collect()] == ["things"]
        query = "SELECT k FROM served.things WHERE p = :partition"
        assert rows(spark.sql(query, args={"partition": "b"})) == [(2,)]
        rates = spark.createDataFrame([("SELIC", 1.0), ("EFFR", 2.0)], "rate_type string, rate_value double")
        sinks.write_table(rates, f"{path}_rates", "rate_type")
        catalog.register_tables(spark, "served", {"interest_rate": f"{path}_rates"})
        catalog.register_rate_views(spark, "served", ["SELIC", "EFFR"])
        assert rows(spark.sql("SELECT rate_value FROM served.effr")) == [(2.0,)]
        root = f"{path}_root/it's"
        sinks.write_table(frame(spark, (1, "000660", 1)).withColumnRenamed("p", "ticker"), f"{root}/serving/prices", "ticker")
        years = spark.createDataFrame([("x", 2024)], "dt_date string, dt_year int")
        sinks.write_table(years, f"{root}/serving/calendar", "dt_year")
        sinks.upsert_versions(frame(spark, (1, "7", 1)).withColumnRenamed("p", "ticker_type"), f"{root}/serving/profile", ["k"], datetime(2024, 1, 1), "ticker_type")
        catalog.register_serving(spark, "served", root)
        assert rows(spark.table("served.prices"), "k", "ticker") == [(1, "000660")]
        assert rows(spark.table("served.calendar"), "dt_year") == [(2024,)]
        assert rows(spark.table("served.profile"), "ticker_type", CURRENT) == [("7", True)]
    finally:
        spark.sql("USE default")
        spark.sql("DROP DATABASE served CASCADE")


def test_a_registered_table_follows_its_upserts(spark, path, rows, monkeypatch):
    first = frame(spark, (1, "a", 1), (2, "it's b", 2), (3, None, 3))
    spark.sql("CREATE DATABASE IF NOT EXISTS followed")
    try:
        commit = sinks.upsert(first, path, ["k"], CHANGED, "p", note_partitions=True)
        assert set(commit.partitions) == {"a", "it's b", None}
        catalog.follow(spark, "followed", "things", commit, ["p"])
        assert rows(spark.table("followed.things"), "k", "p") == [(1, "a"), (2, "it's b"), (3, None)]
        recovered = []
        monkeypatch.setattr(type(spark.catalog), "recoverPartitions", lambda self, name: recovered.append(name))
        wider = frame(spark, (1, "a", 9), (4, "it's new", 4), (5, "007", 5)).withColumn("extra", F.lit("x"))
        commit = sinks.upsert(wider, path, ["k"], CHANGED, "p", note_partitions=True)
        assert commit.columns == (("extra", "string"),) and commit.partitions == ("007", "it's new")
        catalog.follow(spark, "followed", "things", commit, ["p"])
        want = [(1, "a", 9, "x"), (2, "it's b", 2, None), (3, None, 3, None), (4, "it's new", 4, "x"), (5, "007", 5, "x")]
        assert rows(spark.table("followed.things"), "k", "p", "v", "extra") == want
        assert sinks.update(spark, path, "k = 5", {"p": "a", "note": F.lit("moved")}, "p").columns == (("note", "string"),)
        assert not recovered
        monkeypatch.undo()
        catalog.register_tables(spark, "followed", {"things": path}, {"things": ["p"]})
        assert rows(spark.table("followed.things").where("note = 'moved'"), "k", "p") == [(5, "a")]
    finally:
        spark.sql("DROP DATABASE followed CASCADE")
