"""Slowly changing dimension, type 2: changed rows get a new version, old ones are closed."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.predicates import differs
from tallyline.operators.merge import ACTION, INSERT, KEEP, UPDATE
from tallyline.operators.pairing import checked_source, matched, only_new, pair_rows

END, CURRENT = "end_dt", "is_current"
#: When a row of a snapshot was seen.
AT = "_at"


def first_version(snapshot: DataFrame) -> DataFrame:
    """A snapshot as open, current versions."""
    return snapshot.withColumns({END: F.lit(None).cast("timestamp"), CURRENT: F.lit(True)})


def apply_snapshot(
    history: DataFrame,
    snapshot: DataFrame,
    keys: Sequence[str],
    as_of,
    *,
    null_safe: bool = False,
    strategy: str = "shuffle",
    checked: bool = False,
) -> DataFrame:
    """The history after a snapshot.

    A current row whose business columns differ from the snapshot is closed, one day before
    ``as_of``, and followed by an open version. A key without a current row gets one. A key
    missing from the snapshot stays open. A column that only the snapshot has is added, null
    on earlier versions; one that it lacks keeps its value, null on new versions. Only current rows are compared: closed ones are
    passed on without a shuffle, so a key with a very long history costs nothing here.
    ``checked`` says that the snapshot's keys are known to be sound. ``_action`` tells kept rows from closed ("update") and opened ("insert") ones.
    """
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of)
    types = {f.name: f.dataType for f in history.schema}
    business = [c for c in history.columns if c not in (END, CURRENT)]
    added = [c for c in snapshot.columns if c not in types]
    types |= {c: snapshot.schema[c].dataType for c in added}
    arrived = [c for c in business if c in snapshot.columns]
    # what a column held before it came to the table is unknown: its first values are a change
    changed = matched() & (differs(arrived, exclude=keys, null_safe=null_safe) | reduce(operator.or_, [F.col(f"new.`{c}`").isNotNull() for c in added], F.lit(False)))
    closing = (as_of - F.expr("INTERVAL 1 DAY")).cast(types[END])
    actions = (
        F.when(changed, F.array(F.lit(UPDATE), F.lit(INSERT)))
        .when(only_new(), F.array(F.lit(INSERT)))
        .otherwise(F.array(F.lit(KEEP)))
    )

    def side(name: str, column: str) -> Column:
        has = column in (arrived + added if name == "new" else business)
        return F.col(f"{name}.`{column}`") if has else F.lit(None).cast(types[column])

    def versions(pairs: DataFrame) -> DataFrame:
        action = F.col(ACTION)
        values = [
            F.when(action == INSERT, side("new", c).cast(types[c])).otherwise(side("old", c)).alias(c)
            for c in [*business, *added]
        ]
        end = F.when(action == UPDATE, closing).when(action == KEEP, F.col(f"old.`{END}`")).alias(END)
        return pairs.withColumn(ACTION, F.explode(actions)).select(
            *values, end, (action != UPDATE).alias(CURRENT), ACTION
        )

    current, past = history.where(F.col(CURRENT)), history.where(~F.coalesce(F.col(CURRENT), F.lit(False)))
    source = snapshot.select(*arrived, *added)
    source = source if checked else checked_source(source, keys)
    compared = pair_rows(current, source, keys, versions, strategy)
    earlier = [F.lit(None).cast(types[c]).alias(c) for c in added]
    return past.select(*business, *earlier, END, CURRENT, F.lit(KEEP).alias(ACTION)).unionByName(compared)


def history_of(observations: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """The versions that snapshots give, whatever the order in which they arrived.

    ``observations``: the rows of all snapshots, with the moment of each in ``_at``; one row for a key and moment. The result
    is that of applying the snapshots one after the other by time. A key has as many observations as there are
    snapshots, so its own fit one row.
    """
    business = [c for c in observations.columns if c not in (*keys, AT)]
    row = F.struct(AT, *business)
    rows = observations.groupBy(*keys).agg(F.array_sort(F.collect_list(row)).alias("_rows"))
    kind = observations.select(F.array(row)).schema[0].dataType

    def different(a: Column, b: Column) -> Column:
        tests = [~a[c].eqNullSafe(b[c]) if null_safe else F.coalesce(a[c] != b[c], F.lit(False)) for c in business]
        return reduce(operator.or_, tests, F.lit(False))

    def opened(versions: Column, seen: Column) -> Column:
        last = F.get(versions, F.size(versions) - 1)
        return F.when((F.size(versions) > 0) & ~different(last, seen), versions).otherwise(F.concat(versions, F.array(seen)))

    heads = rows.select(*keys, F.aggregate("_rows", F.array().cast(kind), opened).alias("_heads"))
    each = heads.select(*keys, "_heads", F.posexplode("_heads").alias("_place", "_head"))
    following = F.get(F.col("_heads"), F.col("_place") + 1)
    end = following[AT] - F.expr("INTERVAL 1 DAY")
    return each.select(*keys, *[F.col("_head")[c].alias(c) for c in business], end.alias(END), following.isNull().alias(CURRENT))


def apply_late_snapshot(
    history: DataFrame, seen: DataFrame, snapshot: DataFrame, keys: Sequence[str], as_of, *, null_safe: bool = False
) -> DataFrame:
    """All versions, closed and open, of the snapshot's keys after a snapshot that is older than one applied before.

    ``seen``: the keys of each snapshot applied so far, with its moment in ``_at``. At every such moment a key held the version
    that had not ended by then; these rows and the snapshot's make up the history anew. A row seen at ``as_of`` before
    is replaced. The snapshot must have the columns of the history. With plain inequality a null is no change, so where one
    was seen beside a value, the version's value stands for it; with ``null_safe`` the order of snapshots makes no difference.
    """
    business = [c for c in history.columns if c not in (*keys, END, CURRENT)]
    if set(snapshot.columns) != {*keys, *business}:
        raise ValueError("a late snapshot must have the columns of the history")
    moment = as_of if isinstance(as_of, Column) else F.lit(as_of)
    moments = seen.join(snapshot.select(*keys), list(keys), "left_semi").where(F.col(AT) != moment)
    own = history.join(snapshot.select(*keys), list(keys), "left_semi")
    held = moments.join(own, list(keys)).where(F.col(END).isNull() | (F.col(END).cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY") > F.col(AT)))
    first_to_end = F.min_by(F.struct(*business), F.coalesce(F.col(END).cast("timestamp_ntz"), F.lit("9999-12-31").cast("timestamp_ntz")))
    before = held.groupBy(*keys, AT).agg(first_to_end.alias("_held")).select(*keys, *[F.col("_held")[c].alias(c) for c in business], AT)
    types = {f.name: f.dataType for f in history.schema}
    arrived = snapshot.select(*keys, *[F.col(f"`{c}`").cast(types[c]).alias(c) for c in business], moment.alias(AT))
    versions = history_of(before.unionByName(arrived), keys, null_safe)
    return versions.withColumn(END, F.col(END).cast(types[END])).select(*history.columns)
