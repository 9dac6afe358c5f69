"""Writing Parquet tables: first write, upsert, versioned upsert, update and delete by a condition.

Plain Parquet has no row-level update, so a change rewrites the partitions with a changed row,
and no others. A sink first stages the source, then the rows that it takes, then the new
content of the changed partitions, each as a table in shared storage, and publishes the last
by one dynamic overwrite. Which partitions change is a frame too: it is joined, never listed
on the driver. Staged tables are removed once a write has succeeded; until it publishes, the
table is untouched, and a write that failed can simply be run again. Writers of one table must
run one after another.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import groupby, islice
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DateType, IntegralType, StringType, StructField, StructType

from tallyline.operators import scd2
from tallyline.operators.merge import ACTION, FROM, INSERT, UPDATE, altered, assigned, changes, delete_where, merge_checked, met, update_where
from tallyline.operators.pairing import checked_source
from tallyline.operators.scd2 import CURRENT, END
from tallyline.settings import shared_dir
from tallyline.sources.tables import read_table

TEXT = StringType()
#: Types of keys whose ranges prune what an upsert reads.
RANGED = (IntegralType, DateType, StringType)
#: Folders that are emptied at a time.
AT_A_TIME = 16


@dataclass(frozen=True)
class Commit:
    """What a write did: where, and how many rows of each kind; how many the source had, or a condition met. ``columns`` are those
    that are new to the table, with their types; ``partitions``, where asked for, the partition values that are."""

    path: str
    inserted: int = 0
    updated: int = 0
    deleted: int = 0
    source: int = 0
    columns: tuple[tuple[str, str], ...] = ()
    partitions: tuple[str | None, ...] = ()

    @property
    def metrics(self) -> dict[str, int]:
        return {"inserted": self.inserted, "updated": self.updated, "deleted": self.deleted}


def write_table(df: DataFrame, path: str, partition: str | Sequence[str] | None = None, mode: str = "append", **options) -> None:
    """Appends (or overwrites), one directory per partition value.

    The rebalance hint gathers each value's rows, so that a value does not leave a small file
    per task, and lets adaptive execution split a value that holds much of the table.
    """
    columns = [partition] if isinstance(partition, str) else list(partition or [])
    rows = df.hint("rebalance", *columns) if columns else df
    writer = rows.write.mode(mode).options(**options)
    (writer.partitionBy(*columns) if columns else writer).parquet(path)


def upsert(
    new: DataFrame,
    path: str,
    keys: Sequence[str],
    update_when: Column | str | None = None,
    partition: str | None = None,
    schema: StructType | None = None,
    note_partitions: bool = False,
) -> Commit:
    """Creates the table from ``new``, or merges ``new`` into it.

    ``note_partitions`` makes the commit say the partitions that are new to the table, for a catalog that follows it; the
    driver knows as many folders as that from Spark's own commit. ``schema`` is the table's, with all of its columns: it saves merging file footers. Without
    one a partition column has the source's type; partition text is never taken for a number.
    """
    with _Stage(new.sparkSession, path) as stage:
        source = stage.checked(new, keys)
        arrived, ranges = _extent(source, keys)
        old = open_table(new.sparkSession, path, partition, schema, new.schema)
        if old is None:
            write_table(source, path, partition)
            return Commit(path, inserted=arrived, source=arrived, partitions=_values(source, partition) if note_partitions else ())
        taken = stage.keep(changes(_near(old, source, keys, ranges, partition), source, keys, update_when, partition))
        inserted, updated = _counts(taken)
        made: tuple[str | None, ...] = ()
        if inserted or updated:
            rows = taken.drop(ACTION, FROM)
            changed = _changed(taken, partition)
            if note_partitions and partition:
                known = _within(old, partition, changed).select(partition).distinct()
                made = _values(changed.join(known, _same(changed, known, partition), "left_anti"), partition)
            merged = merge_checked(_within(old, partition, changed), rows, keys).drop(ACTION)
            _publish(stage, merged, old, path, partition, changed, moved=updated > 0)
        return Commit(path, inserted, updated, source=arrived, columns=_added(old, new) if inserted or updated else (), partitions=made)


def upsert_versions(
    snapshot: DataFrame,
    path: str,
    keys: Sequence[str],
    as_of,
    partition: str | None = None,
    null_safe: bool = False,
    schema: StructType | None = None,
) -> Commit:
    """Creates a versioned dimension from a snapshot, or applies the snapshot to it.

    The table is partitioned by whether a row is current, then by ``partition``. Closed rows
    are appended and never written again; of the current ones the changed partitions are. The
    append comes first and leaves out rows that are there already, so a run that was cut short
    between the two can be repeated.

    Beside the table, in ``<path>__seen``, stands which keys a snapshot of which moment had. By it a snapshot that is older
    than one applied before splits the versions that it falls into, so the history does not depend on the order in which
    snapshots arrive; the partitions of the keys that it changes are written anew. A table without that record refuses a
    snapshot from before its last closing.
    """
    spark, layout = snapshot.sparkSession, [CURRENT] + ([partition] if partition else [])
    with _Stage(spark, path) as stage:
        source = stage.checked(snapshot, keys)
        arrived = source.count()
        history = open_table(spark, path, partition, schema, scd2.first_version(snapshot).schema)
        if history is None:
            write_table(scd2.first_version(source), path, layout)
            _record(source, path, keys, as_of)
            return Commit(path, inserted=arrived, source=arrived)
        seen = _seen(spark, path, source, keys)
        if _late(history, seen, as_of):
            if seen is None:
                raise ValueError(f"a snapshot of {as_of} is older than the last closing in {path}, which does not say when its versions were seen")
            commit = _split_versions(stage, history, seen, source, path, keys, as_of, partition, null_safe)
            _record(source, path, keys, as_of)
            return Commit(path, *commit, source=arrived)
        current = history.where(F.col(CURRENT))
        versions = stage.keep(scd2.apply_snapshot(current, source, keys, as_of, null_safe=null_safe, checked=True))
        inserted, updated = _counts(versions)
        if inserted or updated:
            closed = versions.where(F.col(ACTION) == UPDATE).drop(ACTION)
            past = history.where(~F.col(CURRENT)).select(*keys, END)
            write_table(closed.join(past, [*keys, END], "left_anti").select(*closed.columns), path, layout)
            changed = _changed(versions.where(F.col(ACTION) != "keep").withColumn(FROM, F.lit(None)), partition)
            open_rows = versions.where(F.col(CURRENT)).drop(ACTION)
            if partition and updated:  # a key may have moved to another partition
                before = current.select(partition).distinct()
                emptied = stage.keep(before.join(open_rows, _same(before, open_rows, partition), "left_anti"))
            write_table(_within(open_rows, partition, changed), path, layout, "overwrite", partitionOverwriteMode="dynamic")
            if partition and updated:
                _empty(stage, read_table(spark, path, CURRENT, schema=history.schema), layout, emptied)
        _record(source, path, keys, as_of)
        return Commit(path, inserted, updated, source=arrived, columns=_added(history, source) if inserted or updated else ())


SEEN_AT = "_seen_at"


def _record(source: DataFrame, path: str, keys: Sequence[str], as_of) -> None:
    """Which keys were seen; again for the same moment if a snapshot is applied again."""
    at = F.lit(as_of).cast("timestamp_ntz").cast("string")
    write_table(source.select(*keys, at.alias(SEEN_AT)), f"{path.rstrip('/')}__seen", SEEN_AT, "overwrite", partitionOverwriteMode="dynamic")


def _seen(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    schema = StructType([*[source.schema[k] for k in keys], StructField(SEEN_AT, TEXT)])
    found = open_table(spark, f"{path.rstrip('/')}__seen", SEEN_AT, schema)
    return None if found is None else found.withColumn(SEEN_AT, F.col(SEEN_AT).cast("timestamp_ntz"))


def _late(history: DataFrame, seen: DataFrame | None, as_of) -> bool:
    """Whether a later snapshot has been applied."""
    at = F.lit(as_of).cast("timestamp_ntz")
    if seen is not None:
        last = seen.agg(F.max(SEEN_AT).alias("at"))
    else:
        last = history.agg((F.max(END).cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")).alias("at"))
    return bool(last.select(F.coalesce(F.col("at") > at, F.lit(False)).alias("late")).first()["late"])


def _split_versions(
    stage: _Stage, history: DataFrame, seen: DataFrame, source: DataFrame, path: str, keys: Sequence[str], as_of, partition: str | None, null_safe: bool
) -> tuple[int, int, int]:
    """Writes the versions of a late snapshot's keys anew; (inserted, updated, deleted)."""
    layout = [CURRENT] + ([partition] if partition else [])
    moment = F.lit(as_of).cast("timestamp_ntz")
    before = history.join(source.select(*keys), list(keys), "left_semi")
    after = stage.keep(scd2.apply_late_snapshot(before, seen.withColumnRenamed(SEEN_AT, scd2.AT), source, keys, moment, null_safe=null_safe))
    gone, came = stage.keep(before.exceptAll(after.select(*before.columns))), stage.keep(after.exceptAll(before))
    n_gone, n_came = gone.count(), came.count()
    if n_gone or n_came:
        altered_keys = gone.select(*keys).union(came.select(*keys)).distinct()
        changed = stage.keep(gone.select(*layout).union(came.select(*layout)).distinct())
        touched = changed.select(partition).distinct() if partition else None
        # of the partitions that change: the rows of other keys, and all versions of the keys that change
        others = _within(history, partition, touched).join(altered_keys, list(keys), "left_anti")
        own = _within(after.join(altered_keys, list(keys), "left_semi"), partition, touched)
        rows = stage.keep(others.unionByName(own.select(*others.columns)))
        was = stage.keep(_within(history, partition, touched).select(*layout).distinct())
        left = rows.select(*layout).distinct()
        on = _same(was, left, CURRENT) & (_same(was, left, partition) if partition else F.lit(True))
        emptied = stage.keep(was.join(left, on, "left_anti"))
        write_table(rows, path, layout, "overwrite", partitionOverwriteMode="dynamic")
        for state in (True, False):
            side = read_table(history.sparkSession, path, F.col(CURRENT) == state, schema=history.schema)
            _empty(stage, side, layout, emptied.where(F.col(CURRENT) == state))
    updated = min(n_gone, n_came)
    return n_came - updated, updated, n_gone - updated


def delete(
    spark: SparkSession, path: str, condition: Column | str, partition: str | None = None, schema: StructType | None = None
) -> Commit:
    """Deletes the rows that meet a condition, rewriting the partitions they are in."""
    condition = F.expr(condition) if isinstance(condition, str) else condition
    with _Stage(spark, path) as stage:
        old = open_table(spark, path, partition, schema)
        if old is None:
            return Commit(path)
        gone = old.where(condition)
        deleted = gone.count()
        if deleted:
            changed = stage.keep(gone.select(partition).distinct()) if partition else None
            _publish(stage, delete_where(_within(old, partition, changed), condition), old, path, partition, changed, moved=True)
        return Commit(path, deleted=deleted)


def update(
    spark: SparkSession,
    path: str,
    condition: Column | str,
    assign: Mapping[str, Any],
    partition: str | None = None,
    schema: StructType | None = None,
    insert: Mapping[str, Any] | None = None,
) -> Commit:
    """Gives the rows that meet a condition new values, rewriting the partitions of the rows that this changes.

    ``assign`` is that of ``update_where``. If no row meets the condition and ``insert`` is given, a row with these values is
    added, the assignments applied to it; this makes the table if there is none. The commit's ``source`` is the number
    of rows that met the condition, ``updated`` of those that changed.
    """
    with _Stage(spark, path) as stage:
        old = open_table(spark, path, partition, schema)
        matched = changing = 0
        if old is not None:
            counts = old.where(met(condition)).agg(F.count(F.lit(1)).alias("met"), F.count_if(altered(old, assign)).alias("changing")).first()
            matched, changing = counts["met"], counts["changing"]
        if not matched and insert is not None:
            row = stage.keep(_inserted(spark, old.schema if old is not None else schema, assign, insert))
            write_table(row, path, partition)
            return Commit(path, inserted=1, columns=_added(old, row) if old is not None else ())
        if changing:
            changed = None
            if partition:
                hits = old.where(met(condition) & altered(old, assign))
                goes = hits.select(assigned(old, assign)[partition].alias(partition)) if partition in assign else hits.select(partition)
                changed = stage.keep(hits.select(partition).union(goes).distinct())
            rows = update_where(_within(old, partition, changed), condition, assign)
            _publish(stage, rows, old, path, partition, changed, moved=partition in assign)
            return Commit(path, updated=changing, source=matched, columns=_added(old, rows))
        return Commit(path, source=matched)


def open_table(
    spark: SparkSession, path: str, partition: str | None = None, schema: StructType | None = None, like: StructType | None = None
) -> DataFrame | None:
    """The table, or None if nothing is there.

    Without a declared schema the columns come from the files' footers, and a partition column
    takes the type it has in ``like``, else text: as a guess, ``000660`` would be a number.
    """
    try:
        if schema is None:
            found = read_table(spark, path).schema
            types = {f.name: f.dataType for f in like or []}
            types |= {partition: types.get(partition, TEXT), CURRENT: BooleanType()}
            schema = StructType([StructField(f.name, types[f.name] if f.name in (partition, CURRENT) else f.dataType, f.nullable) for f in found])
        elif like is not None:  # a column that is new to the table
            schema = StructType(schema.fields + [f for f in like if f.name not in schema.fieldNames()])
        return read_table(spark, path, schema=schema)
    except AnalysisException:  # no such path, or nothing written there yet
        return None


class _Stage:
    """A folder of staged tables in shared storage, removed once the write has succeeded."""

    def __init__(self, spark: SparkSession, table: str):
        self.spark = spark
        self.path = f"{shared_dir(spark, f'{table.rstrip('/')}__staging')}/staged-{uuid.uuid4().hex}"
        self.tables = 0

    def keep(self, rows: DataFrame) -> DataFrame:
        """The rows as a table that is written once and read from then on."""
        self.tables += 1
        path = f"{self.path}/{self.tables}"
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def checked(self, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        """The source, computed once; reading it fails on a null key or a repeated one."""
        return checked_source(self.keep(rows), keys)

    def __enter__(self) -> _Stage:
        return self

    def __exit__(self, failure, *_) -> None:
        if failure is None:
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)


def staging(spark: SparkSession, table: str) -> _Stage:
    """For what a load reads again after it has changed the tables that it comes from."""
    return _Stage(spark, table)


def _counts(rows: DataFrame) -> tuple[int, int]:
    found = {r[ACTION]: r["n"] for r in rows.groupBy(ACTION).agg(F.count(F.lit(1)).alias("n")).collect()}
    return found.get(INSERT, 0), found.get(UPDATE, 0)


def _changed(taken: DataFrame, partition: str | None) -> DataFrame | None:
    """The partitions that get or lose a row, as a frame; None for a table without partitions."""
    if partition is None:
        return None
    kind = taken.schema[partition].dataType
    gets = taken.select(partition)
    loses = taken.where(F.col(ACTION) == UPDATE).select(F.col(FROM).cast(kind).alias(partition))
    return gets.union(loses).distinct()


def _values(rows: DataFrame, partition: str | None) -> tuple[str | None, ...]:
    if partition is None:
        return ()
    return tuple(r[0] for r in rows.select(F.col(partition).cast("string")).distinct().orderBy(partition).toLocalIterator())


def _same(a: DataFrame, b: DataFrame, column: str) -> Column:
    return a[column].eqNullSafe(b[column])


def selective(values: DataFrame, column: str) -> DataFrame:
    """The same rows, under a comparison that all of them meet: Spark prunes partitions at run time only by a side that has
    one."""
    return values.where(F.coalesce(F.col(column).cast("string"), F.lit("")) >= "")


def _within(df: DataFrame, partition: str | None, changed: DataFrame | None) -> DataFrame:
    """Rows in the changed partitions. Of a table, Spark prunes the others at run time where the values can be broadcast; that
    takes a plain equality, so the null partition goes a way of its own."""
    if changed is None:
        return df
    values = selective(changed.select(F.col(partition).alias("_changed")), "_changed")
    among_nulls = changed.agg(F.coalesce(F.bool_or(F.col(partition).isNull()), F.lit(False))).scalar()
    return df.join(values, df[partition] == values["_changed"], "left_semi").union(df.where(F.col(partition).isNull() & among_nulls))


def _publish(
    stage: _Stage, rows: DataFrame, old: DataFrame, path: str, partition: str | None, changed: DataFrame | None, moved: bool
) -> None:
    """Stages the new content of the changed partitions and writes it over them."""
    staged = stage.keep(rows)
    if partition is None:
        write_table(staged, path, None, "overwrite", partitionOverwriteMode="static")
        return
    left = staged.select(partition).distinct()
    emptied = changed.join(left, _same(changed, left, partition), "left_anti") if moved else None
    write_table(staged, path, partition, "overwrite", partitionOverwriteMode="dynamic")
    if emptied is not None:
        _empty(stage, read_table(old.sparkSession, path, schema=old.schema), [partition], emptied)


def _empty(stage: _Stage, table: DataFrame, layout: list[str], emptied: DataFrame) -> None:
    """A dynamic overwrite leaves alone a partition that lost its last row: it gets an empty file instead.

    One job lists the files of all emptied partitions and another makes the empty file, whatever their number. Copying it and
    deleting the files are calls to the file system, as those of Spark's own commit are; the list comes through
    an iterator. The folders stay, as a catalog may know them.
    """
    if emptied.isEmpty():
        return
    spark, partition = table.sparkSession, layout[-1]
    rows = _within(table.select(partition, F.col("_metadata.file_path").alias("_file")), partition, emptied)
    files = rows.select("_file").distinct().withColumn("_folder", F.regexp_replace("_file", "/[^/]*$", "")).orderBy("_folder")
    java, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()
    path = lambda text: java.org.apache.hadoop.fs.Path(java.java.net.URI(text))
    none = stage.keep(spark.createDataFrame([], StructType([f for f in table.schema if f.name not in layout])).coalesce(1))
    empty = path(none.inputFiles()[0])

    def emptied_folder(folder: str, files: list[str]) -> None:
        to = path(f"{folder}/part-empty-{uuid.uuid4().hex}.parquet")
        java.org.apache.hadoop.fs.FileUtil.copy(empty.getFileSystem(hadoop), empty, to.getFileSystem(hadoop), to, False, hadoop)
        for file in files:
            path(file).getFileSystem(hadoop).delete(path(file), False)

    folders = ((folder, [r["_file"] for r in found]) for folder, found in groupby(files.toLocalIterator(), key=lambda r: r["_folder"]))
    with ThreadPoolExecutor(AT_A_TIME) as pool:
        for some in chunks(folders, 64 * AT_A_TIME):
            list(pool.map(lambda f: emptied_folder(*f), some))


def chunks(items: Iterator, size: int) -> Iterator[list]:
    while some := list(islice(items, size)):
        yield some


def _extent(source: DataFrame, keys: Sequence[str]) -> tuple[int, dict[str, tuple[Any, Any]]]:
    """The number of rows, and the least and greatest value of each key that Parquet keeps ranges of."""
    ranged = [k for k in keys if isinstance(source.schema[k].dataType, RANGED)]
    found = source.agg(F.count(F.lit(1)), *[f(k) for k in ranged for f in (F.min, F.max)]).first()
    return found[0], {k: (found[2 * i + 1], found[2 * i + 2]) for i, k in enumerate(ranged) if found[2 * i + 1] is not None}


def _near(old: DataFrame, source: DataFrame, keys: Sequence[str], ranges: Mapping[str, tuple[Any, Any]], partition: str | None) -> DataFrame:
    """The table's rows that can have a key of the source: within its keys' ranges, by which Spark prunes partitions and row
    groups, and in its partitions, if the partition is a key, by which Spark prunes at run time."""

    def bound(value: Any, kind: DataType) -> Column:
        return F.lit(value).cast(kind)

    for key, (least, most) in ranges.items():
        if old.schema[key].dataType == source.schema[key].dataType:
            kind = old.schema[key].dataType
            old = old.where((F.col(key) >= bound(least, kind)) & (F.col(key) <= bound(most, kind)))
    if partition in keys:
        values = selective(source.select(F.col(partition).alias("_fed")).distinct(), "_fed")
        old = old.join(values, old[partition] == values["_fed"], "left_semi")
    return old


def _added(old: DataFrame, rows: DataFrame) -> tuple[tuple[str, str], ...]:
    return tuple((f.name, f.dataType.simpleString()) for f in rows.schema if f.name not in old.columns)


def _inserted(spark: SparkSession, schema: StructType | None, assign: Mapping[str, Any], insert: Mapping[str, Any]) -> DataFrame:
    """The one row that an update inserts."""
    types = {f.name: f.dataType for f in schema or []}
    names = [*types, *[n for n in insert if n not in types]]
    row = spark.range(1).select(*[F.lit(insert.get(n)).cast(types[n]) if n in types else F.lit(insert[n]).alias(n) for n in names])
    return update_where(row.toDF(*names), F.lit(True), assign)
