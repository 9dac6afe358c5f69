from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyline.functions.predicates import differs
from tallyline.operators.merge import ACTION, delete_where, merge, merge_metrics

OLD = [(1, "a", 10.0), (2, "b", 20.0), (3, None, 30.0), (4, "d", 40.0), (None, "n", 0.0), (None, "m", 0.0)]
NEW = [(2, "b", 21.0), (3, "c", 30.0), (4, "d", 40.0), (5, "e", 50.0)]
SCHEMA = "k int, s string, v double"
STRATEGIES = ["probe", "shuffle"]


@pytest.fixture
def old(spark):
    return spark.createDataFrame(OLD, SCHEMA)


@pytest.fixture
def new(spark):
    return spark.createDataFrame(NEW, SCHEMA)


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_update_all_without_a_condition(old, new, rows, strategy):
    got = rows(merge(old, new, ["k"], strategy=strategy))
    assert got == [
        (None, "m", 0.0, "keep"), (None, "n", 0.0, "keep"), (1, "a", 10.0, "keep"), (2, "b", 21.0, "update"),
        (3, "c", 30.0, "update"), (4, "d", 40.0, "update"), (5, "e", 50.0, "insert"),
    ]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_plain_inequality_skips_a_null_change(old, new, rows, strategy):
    got = dict(rows(merge(old, new, ["k"], "old.s <> new.s OR old.v <> new.v", strategy), "k", ACTION))
    assert got == {None: "keep", 1: "keep", 2: "update", 3: "keep", 4: "keep", 5: "insert"}
    null_safe = differs(["s", "v"], null_safe=True)
    got = dict(rows(merge(old, new, ["k"], null_safe, strategy), "k", ACTION))
    assert got[3] == "update" and got[4] == "keep"


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_unchecked_row_keeps_all_its_old_values(old, new, rows, strategy):
    got = {r[0]: r for r in rows(merge(old, new, ["k"], "old.v <> new.v", strategy))}
    assert got[3] == (3, None, 30.0, "keep")


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_merging_again_changes_nothing(old, new, rows, strategy):
    once = merge(old, new, ["k"], differs(["s", "v"], null_safe=True), strategy).drop(ACTION)
    twice = merge(once, new, ["k"], differs(["s", "v"], null_safe=True), strategy)
    assert rows(twice.drop(ACTION)) == rows(once)
    assert merge_metrics(twice).first().asDict() == {"inserted": 0, "updated": 0, "kept": 7, "deleted": 0}


def test_metrics_add_up_to_the_source(old, new):
    counts = merge_metrics(merge(old, new, ["k"])).first()
    assert counts.inserted + counts.updated == len(NEW)
    assert counts.inserted + counts.updated + counts.kept == len(OLD) + 1


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_columns_of_one_side_only(spark, old, rows, strategy):
    new = spark.createDataFrame([(2, 99.0, "x"), (5, 50.0, "y")], "k int, v double, extra string")
    got = rows(merge(old.where("k <= 2"), new, ["k"], strategy=strategy))
    assert got == [(1, "a", 10.0, None, "keep"), (2, "b", 99.0, "x", "update"), (5, None, 50.0, "y", "insert")]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_bad_sources_are_refused(spark, old, strategy):
    twice = spark.createDataFrame([(1, "x", 1.0), (1, "y", 2.0)], SCHEMA)
    with pytest.raises(Exception, match="more than one source row"):
        merge(old, twice, ["k"], strategy=strategy).collect()
    null = spark.createDataFrame([(None, "x", 1.0)], SCHEMA)
    with pytest.raises(Exception, match="null key"):
        merge(old, null, ["k"], strategy=strategy).collect()


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_empty_sides(old, new, rows, strategy):
    nothing = new.where(F.lit(False))
    assert rows(merge(old, nothing, ["k"], strategy=strategy), "k", ACTION) == sorted(
        [(r[0], "keep") for r in OLD], key=lambda r: [(v is not None, str(v)) for v in r]
    )
    assert rows(merge(nothing, new, ["k"], strategy=strategy), ACTION) == [("insert",)] * len(NEW)


def test_compound_keys_and_odd_names(spark, rows):
    schema = "`a b` int, `c.d` int, v int"
    old, new = spark.createDataFrame([(1, 1, 1), (1, 2, 2)], schema), spark.createDataFrame([(1, 2, 5), (2, 1, 6)], schema)
    for strategy in STRATEGIES:
        got = rows(merge(old.withColumnsRenamed({"c.d": "c_d"}), new.withColumnsRenamed({"c.d": "c_d"}), ["a b", "c_d"], strategy=strategy))
        assert got == [(1, 1, 1, "keep"), (1, 2, 5, "update"), (2, 1, 6, "insert")]


def test_strategies_agree_on_a_table_with_mostly_null_keys(spark):
    """A third and more of the table without a key: it must not meet in one task."""
    old = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"), (F.col("id") * 2).alias("v")
    )
    new = spark.range(1500, 4500).select(F.col("id").alias("k"), (F.col("id") * 5).alias("v"))
    frames = [merge(old, new, ["k"], "old.v <> new.v", s) for s in STRATEGIES]
    assert frames[0].exceptAll(frames[1]).isEmpty() and frames[1].exceptAll(frames[0]).isEmpty()
    assert frames[0].where("k IS NULL").count() == 1000


def test_a_small_source_leaves_the_table_unshuffled(spark, tmp_path):
    spark.range(200_000).select(F.col("id").alias("k"), F.col("id").alias("v")).write.parquet(str(tmp_path / "t"))
    old = spark.read.parquet(str(tmp_path / "t"))
    spark.createDataFrame([(5, 1), (999_999, 2)], "k long, v long").coalesce(1).write.parquet(str(tmp_path / "s"))
    new = spark.read.parquet(str(tmp_path / "s"))
    plan = merge(old, new, ["k"], strategy="probe")._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" not in plan and "LeftOuter, BuildRight" in plan
    plan = merge(old, old, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "FullOuter" in plan


def test_unknown_strategy(old, new):
    with pytest.raises(ValueError):
        merge(old, new, ["k"], strategy="magic")


def test_delete_keeps_rows_where_the_condition_is_null(old, rows):
    assert rows(delete_where(old, "s = 'a'"), "k") == [(None,), (None,), (2,), (3,), (4,)]
