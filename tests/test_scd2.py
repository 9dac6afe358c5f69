from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyline.operators import scd2
from tallyline.operators.merge import ACTION
from tallyline.operators.scd2 import apply_snapshot, first_version

SCHEMA = "k int, name string, size int"
AS_OF = datetime(2024, 3, 10)
CLOSED = datetime(2024, 3, 9)


@pytest.fixture
def history(spark):
    start = first_version(spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", 3)], SCHEMA))
    past = spark.createDataFrame(
        [(1, "a0", 1, datetime(2020, 1, 1), False), (9, "gone", 9, datetime(2020, 1, 1), False)],
        SCHEMA + ", end_dt timestamp, is_current boolean",
    )
    return start.unionByName(past)


@pytest.mark.parametrize("strategy", ["probe", "shuffle"])
def test_versions(spark, history, rows, strategy):
    # 1 returns to its earlier name, 2 is unchanged, 3 is absent, 4 is new, 9 has closed versions only
    snapshot = spark.createDataFrame([(1, "a0", 1), (2, "b", 2), (4, "d", 4), (9, "gone", 9)], SCHEMA)
    got = rows(apply_snapshot(history, snapshot, ["k"], AS_OF, strategy=strategy))
    long_ago = datetime(2020, 1, 1)
    assert got == sorted(
        [
            (1, "a0", 1, long_ago, False, "keep"), (1, "a", 1, CLOSED, False, "update"), (1, "a0", 1, None, True, "insert"),
            (2, "b", 2, None, True, "keep"), (3, "c", 3, None, True, "keep"), (4, "d", 4, None, True, "insert"),
            (9, "gone", 9, long_ago, False, "keep"), (9, "gone", 9, None, True, "insert"),
        ],
        key=lambda r: [(v is not None, str(v)) for v in r],
    )


def test_second_run_is_a_no_op_and_history_never_shrinks(spark, history, rows):
    snapshot = spark.createDataFrame([(1, "x", 1), (2, "b", 7), (5, "e", 5)], SCHEMA)
    once = apply_snapshot(history, snapshot, ["k"], AS_OF)
    assert once.count() == history.count() + 3
    twice = apply_snapshot(once.drop(ACTION), snapshot, ["k"], datetime(2024, 3, 11))
    assert rows(twice.drop(ACTION)) == rows(once.drop(ACTION))
    assert twice.where(f"{ACTION} <> 'keep'").isEmpty()


def test_one_current_version_per_key(spark, history):
    frame = history
    for day, size in enumerate((5, 6, 5)):
        snapshot = spark.createDataFrame([(1, "a", size), (2, "b", size)], SCHEMA)
        frame = apply_snapshot(frame, snapshot, ["k"], datetime(2024, 4, day + 1)).drop(ACTION)
    current = frame.where("is_current").groupBy("k").count()
    assert current.where("count > 1").isEmpty()
    assert frame.where("k = 1").count() == 5


def test_null_changes_count_only_when_asked(spark, history):
    snapshot = spark.createDataFrame([(1, None, 1)], SCHEMA)
    assert apply_snapshot(history, snapshot, ["k"], AS_OF).where(f"{ACTION} <> 'keep'").isEmpty()
    assert apply_snapshot(history, snapshot, ["k"], AS_OF, null_safe=True).where(f"{ACTION} <> 'keep'").count() == 2


def test_repeated_snapshot_key_is_refused(spark, history):
    twice = spark.createDataFrame([(1, "a", 1), (1, "b", 1)], SCHEMA)
    with pytest.raises(Exception, match="more than one source row"):
        apply_snapshot(history, twice, ["k"], AS_OF).collect()


def observed(spark, *data):
    return spark.createDataFrame([(k, v, datetime.fromisoformat(at)) for k, v, at in data], "k int, v string, _at timestamp_ntz")


def test_history_of_observations_in_any_order(spark, rows):
    seen = observed(spark, (1, "x", "2024-03-01"), (1, "y", "2024-02-01"), (1, "x", "2024-01-01"), (2, None, "2024-01-01"), (2, "x", "2024-02-01"), (2, "y", "2024-03-01"), (3, "x", "2024-02-01"))
    day = datetime.fromisoformat
    plain = [(2, None, None, True), (3, "x", None, True)]
    assert rows(scd2.history_of(seen, ["k"])) == sorted(
        [(1, "x", day("2024-01-31"), False), (1, "y", day("2024-02-29"), False), (1, "x", None, True), *plain], key=lambda r: [(v is not None, str(v)) for v in r]
    )
    strict = [r for r in rows(scd2.history_of(seen, ["k"], null_safe=True)) if r[0] == 2]
    assert {(r[1], r[2]) for r in strict} == {(None, day("2024-01-31")), ("x", day("2024-02-29")), ("y", None)}
    assert scd2.history_of(seen.where("k > 9"), ["k"]).collect() == []


@pytest.mark.parametrize("null_safe", [False, True])
def test_a_late_snapshot_splits_versions_as_if_it_had_come_in_time(spark, rows, null_safe):
    """Random snapshots, with keys that are absent and values that are null, one of them applied last."""
    dice = random.Random(11 + null_safe)
    days = [f"2024-0{m}-{d}" for m in range(1, 6) for d in ("01", "15")]
    snapshots = {at: {k: dice.choice(["x", "y", None]) for k in range(60) if dice.random() < 0.7} for at in days}
    schema = "k int, v string, end_dt timestamp_ntz, is_current boolean"

    def applied(order):
        history = spark.createDataFrame([], schema)
        for at in order:
            snapshot = spark.createDataFrame([(k, v) for k, v in snapshots[at].items()], "k int, v string")
            history = scd2.apply_snapshot(history, snapshot, ["k"], F.lit(at).cast("timestamp_ntz"), null_safe=null_safe).drop("_action")
            history = spark.createDataFrame(history.collect(), schema)
        return history

    late = days[4]
    history = applied([at for at in days if at != late])
    seen = spark.createDataFrame([(k, datetime.fromisoformat(at)) for at in days if at != late for k in snapshots[at]], "k int, _at timestamp_ntz")
    snapshot = spark.createDataFrame([(k, v) for k, v in snapshots[late].items()], "k int, v string")
    got = scd2.apply_late_snapshot(history, seen, snapshot, ["k"], F.lit(late).cast("timestamp_ntz"), null_safe=null_safe)
    want = applied(days).join(snapshot.select("k"), "k", "left_semi")
    if null_safe:
        assert rows(got) == rows(want)
    else:  # a null that was seen beside a value is not in the history: there the value stands for it
        known = [k for k in snapshots[late] if all(snapshots[at].get(k, "x") is not None for at in days)]
        assert known and rows(got.where(F.col("k").isin(known))) == rows(want.where(F.col("k").isin(known)))


def test_a_late_snapshot_with_other_columns_is_refused(spark):
    history = spark.createDataFrame([], "k int, v string, end_dt timestamp_ntz, is_current boolean")
    with pytest.raises(ValueError, match="columns"):
        scd2.apply_late_snapshot(history, observed(spark, (1, "x", "2024-01-01")).drop("v"), spark.createDataFrame([(1, "x", 2)], "k int, v string, w int"), ["k"], F.lit("2024-01-01").cast("timestamp_ntz"))
