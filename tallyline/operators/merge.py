"""Upsert of a source into a table, as a frame operator."""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.predicates import keys_equal
from tallyline.operators.pairing import checked_source, matched, only_new, pair_rows

ACTION, FROM = "_action", "_from"
KEEP, UPDATE, INSERT = "keep", "update", "insert"


def merge(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    update_when: Column | str | None = None,
    strategy: str = "shuffle",
) -> DataFrame:
    """The table after the upsert, with an ``_action`` column (keep, update or insert).

    A matched row takes every value of the source when ``update_when`` holds (always, when
    none is given); an unmatched source row is inserted; nothing is deleted. The condition
    reads ``old.<column>`` and ``new.<column>``; null counts as false. Columns only the
    source has are added, null on rows not taken from it; columns only the table has keep
    their values, null on inserted rows.
    """
    return merge_checked(old, checked_source(new, keys), keys, update_when, strategy)


def changes(old: DataFrame, new: DataFrame, keys: Sequence[str], update_when: Column | str | None, partition: str | None) -> DataFrame:
    """The source rows that an upsert takes: their ``_action``, and in ``_from`` the partition of the row they replace.

    Of the table only keys, partition and what the condition reads are scanned. A small source is broadcast to it; source
    rows without a match are found against the keys that matched, which are no more than the source has.
    """
    condition = F.lit(True) if update_when is None else update_when
    condition = F.expr(condition) if isinstance(condition, str) else condition
    origin = F.col(f"old.`{partition}`") if partition else F.lit(None).cast("string")
    hits = old.alias("old").join(new.alias("new"), keys_equal(keys), "inner").select(
        *[F.col(f"new.`{k}`").alias(k) for k in keys], F.coalesce(condition, F.lit(False)).alias("_taken"), origin.alias(FROM)
    )
    met = new.join(hits, list(keys), "left").where("_taken IS NULL OR _taken")
    return met.select(*[F.col(f"`{c}`") for c in new.columns], F.when(F.col("_taken"), UPDATE).otherwise(INSERT).alias(ACTION), FROM)


def merge_checked(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    update_when: Column | str | None = None,
    strategy: str = "shuffle",
) -> DataFrame:
    """``merge`` for a source whose keys are known to be sound."""
    condition = F.lit(True) if update_when is None else update_when
    condition = F.expr(condition) if isinstance(condition, str) else condition
    action = F.when(only_new(), INSERT).when(matched() & F.coalesce(condition, F.lit(False)), UPDATE).otherwise(KEEP)
    old_types = {f.name: f.dataType for f in old.schema}
    names = old.columns + [c for c in new.columns if c not in old_types]

    def value(name: str) -> Column:
        if name not in new.columns:
            return F.col(f"old.`{name}`")
        taken, incoming = F.col(ACTION) != KEEP, F.col(f"new.`{name}`")
        if name not in old_types:
            return F.when(taken, incoming)
        return F.when(taken, incoming.cast(old_types[name])).otherwise(F.col(f"old.`{name}`"))

    def table_row(pairs: DataFrame) -> DataFrame:
        return pairs.withColumn(ACTION, action).select(*[value(c).alias(c) for c in names], ACTION)

    return pair_rows(old, new, keys, table_row, strategy)


def merge_metrics(merged: DataFrame) -> DataFrame:
    """One row: how many rows the upsert inserted, updated and left alone; it deletes none."""

    def rows(action: str) -> Column:
        return F.count_if(F.col(ACTION) == action)

    return merged.agg(
        rows(INSERT).alias("inserted"),
        rows(UPDATE).alias("updated"),
        rows(KEEP).alias("kept"),
        F.lit(0).cast("long").alias("deleted"),
    )


def delete_where(df: DataFrame, condition: Column | str) -> DataFrame:
    """The rows for which the condition does not hold; null counts as not holding."""
    condition = F.expr(condition) if isinstance(condition, str) else condition
    return df.where(~F.coalesce(condition, F.lit(False)))


def met(condition: Column | str) -> Column:
    """Whether a row meets a condition; null counts as not."""
    return F.coalesce(F.expr(condition) if isinstance(condition, str) else condition, F.lit(False))


def update_where(df: DataFrame, condition: Column | str, assign: Mapping[str, Any]) -> DataFrame:
    """The rows, those that meet a condition with new values.

    ``assign`` maps columns to constants or to expressions over the row as it was; None empties a column. A value takes the
    type of its column. A column that is not there yet is added, null on the rows that do not meet the condition.
    """
    taken, new = met(condition), assigned(df, assign)
    kept = [F.when(taken, new[c]).otherwise(F.col(f"`{c}`")).alias(c) if c in new else F.col(f"`{c}`") for c in df.columns]
    return df.select(*kept, *[F.when(taken, new[c]).alias(c) for c in new if c not in df.columns])


def assigned(df: DataFrame, assign: Mapping[str, Any]) -> dict[str, Column]:
    """The assignments as columns of their columns' types."""
    if not assign:
        raise ValueError("an update needs an assignment")
    types = {f.name: f.dataType for f in df.schema}
    columns = {name: value if isinstance(value, Column) else F.lit(value) for name, value in assign.items()}
    return {name: value.cast(types[name]) if name in types else value for name, value in columns.items()}


def altered(df: DataFrame, assign: Mapping[str, Any]) -> Column:
    """Whether the assignments change anything of a row."""
    new = assigned(df, assign)
    return reduce(operator.or_, [~F.col(f"`{n}`").eqNullSafe(v) if n in df.columns else v.isNotNull() for n, v in new.items()])
