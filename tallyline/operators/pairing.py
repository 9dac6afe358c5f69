"""Pairing table rows with source rows on a key: the common half of upsert and versioning."""

from __future__ import annotations

import operator
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.predicates import keys_equal

STRATEGIES = ("shuffle", "probe")


def matched() -> Column:
    return F.col("_in_old").isNotNull() & F.col("_in_new").isNotNull()


def only_new() -> Column:
    return F.col("_in_old").isNull()


def checked_source(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows; fails at run time on a null key or on two rows with one key.

    Two source rows for one table row would make the result depend on chance. The check is a
    scalar over key counts that combine before the shuffle, so even a key that repeats in
    much of a bad source is found without being gathered in one task.
    """
    fault = F.when(_null_key(keys), 2).when(F.col("_rows") > 1, 1).otherwise(0)
    worst = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).agg(F.max(fault).alias("_worst"))
    sound = (
        F.when(F.col("_worst") == 2, F.raise_error(F.lit("null key in the source")).cast("boolean"))
        .when(F.col("_worst") == 1, F.raise_error(F.lit("more than one source row for a key")).cast("boolean"))
        .otherwise(F.lit(True))
    )
    return source.where(worst.select(sound).scalar())


def pair_rows(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    select: Callable[[DataFrame], DataFrame],
    strategy: str = "shuffle",
) -> DataFrame:
    """``select`` of every row of both sides, matched on ``keys``.

    What ``select`` is given has the columns of both sides, as ``old.<column>`` and
    ``new.<column>``, null for a side without a match. Null keys match nothing. Strategies,
    equal in result:

    * ``shuffle``: one full outer join. Table rows with a null key go round it, since they
      would all meet in one task.
    * ``probe``: the table is joined to the source from the left and so stays where it is
      when Spark can broadcast the source; source rows without a match are found against
      the keys that did match.

    ``shuffle`` is the default; ``probe`` is for a source that is small beside the table.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}")
    pairs = (_probe if strategy == "probe" else _shuffle)(old, new, list(keys))
    return reduce(DataFrame.unionByName, [select(p) for p in pairs])


def _shuffle(old: DataFrame, new: DataFrame, keys: list[str]) -> list[DataFrame]:
    on = keys_equal(keys)
    return [
        _side(old.where(~_null_key(keys)), "old").join(_side(new, "new"), on, "full_outer"),
        _side(old.where(_null_key(keys)), "old").join(_side(_none(new), "new"), on, "left_outer"),
    ]


def _probe(old: DataFrame, new: DataFrame, keys: list[str]) -> list[DataFrame]:
    on = keys_equal(keys)
    matched_keys = old.select(*keys).join(new.select(*keys), keys, "left_semi").distinct()
    unmatched = new.join(matched_keys, keys, "left_anti")
    return [
        _side(old, "old").join(_side(new, "new"), on, "left_outer"),
        _side(unmatched, "new").join(_side(_none(old), "old"), on, "left_outer"),
    ]


def _side(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(f"_in_{name}", F.lit(True)).alias(name)


def _none(df: DataFrame) -> DataFrame:
    """No rows: Catalyst folds an outer join with it into null columns."""
    return df.where(F.lit(False))


def _null_key(keys: Sequence[str]) -> Column:
    return reduce(operator.or_, [F.col(k).isNull() for k in keys])
