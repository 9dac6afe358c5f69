"""Exact duplicates with a heavy-hitter split.

Every text gets the SHA-256 digest of its normalised form; texts with one digest are taken as equal. Misra-Gries counters
in each task find the digests that may be frequent; their exact sizes and winners are counted in a second pass, which
combines before the shuffle. There are at most ``COUNTERS`` + 1 of them at any size of the table, so they are broadcast,
and rows with a frequent digest are decided where they are read. The rows left, whose groups hold no more than
2 / (``COUNTERS`` + 1) of the table each, are shuffled by digest.

Null texts are empty texts. Of the rows with one digest the one with the largest doc_id stays; a null doc_id is the
smallest, and of rows that share that doc_id too one stays. An empty table gives no rows. Columns of the documents may have
any names but those that start with two underscores.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.frames import kept_table

#: Counters of a task. A digest with 2 / (COUNTERS + 1) of all rows or more is surely found.
COUNTERS = 2047
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """The text with A-Z in lower case and nothing else changed; null is empty."""
    text = F.coalesce(text, F.lit(""))
    # lower() is fast, and does no more than that where there are only ASCII signs
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(text), 256))


def duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", counters: int = COUNTERS) -> DataFrame:
    """One row for each document: doc_id, keep_id (doc_id of the row that stays), group_size, kept, digest."""
    rows = docs.select(docs[f"`{key}`"].alias("doc_id"), digest(docs[f"`{text}`"]).alias("digest"), F.monotonically_increasing_id().alias("row"))
    return _judged(kept_table(rows, "digests"), counters).drop("row")


def deduplicated(docs: DataFrame, text: str = "text", key: str = "doc_id", counters: int = COUNTERS) -> DataFrame:
    """The documents that stay, with all of their columns."""
    numbered = kept_table(docs.withColumns({"__digest": digest(docs[f"`{text}`"]), "__row": F.monotonically_increasing_id()}), "numbered")
    rows = numbered.select(F.col(f"`{key}`").alias("doc_id"), F.col("__digest").alias("digest"), F.col("__row").alias("row"))
    stays = _judged(rows, counters).where("kept").select(F.col("row").alias("__stays"))
    return numbered.join(stays, numbered["__row"] == stays["__stays"], "left_semi").drop("__digest", "__row")


def frequent(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """(digest): at most ``counters`` + 1, among them every one that has 2 / (``counters`` + 1) of the rows or more, if it has two.

    A task's counter falls short of the true count by at most 1 / (``counters`` + 1) of the task's rows, so the sum over
    tasks does by that share of all rows; and no more than ``counters`` + 1 sums can reach that share.
    """

    def summarised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary: Counter[bytes] = Counter()
        for batch in batches:
            counts = pa.compute.value_counts(batch.column(0))
            summary.update(dict(zip(counts.field(0).to_pylist(), counts.field(1).to_pylist(), strict=True)))
            if len(summary) > counters:
                surplus = sorted(summary.values(), reverse=True)[counters]
                summary = Counter({d: n - surplus for d, n in summary.items() if n > surplus})
        yield pa.RecordBatch.from_arrays([pa.array(list(summary), pa.binary()), pa.array(list(summary.values()), pa.int64())], ["digest", "n"])

    found = digests.select("digest").mapInArrow(summarised, "digest binary, n bigint")
    least = digests.count() / (counters + 1)
    return found.groupBy("digest").agg(F.sum("n").alias("n")).where((F.col("n") >= least) & (F.col("n") > 1)).select("digest")


def _judged(rows: DataFrame, counters: int) -> DataFrame:
    # of struct(known, doc_id, row) the greatest: a null doc_id is the smallest
    best = F.max(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "row"))
    suspects = F.broadcast(kept_table(frequent(rows, counters), "frequent"))
    verified = kept_table(rows.join(suspects, "digest").groupBy("digest").agg(best.alias("best"), F.count("*").alias("n")), "winners")
    marked = rows.join(F.broadcast(verified), "digest", "left")
    same = Window.partitionBy("digest")
    rest = marked.where("n IS NULL").withColumns({"best": best.over(same), "n": F.count("*").over(same)})
    return marked.where("n IS NOT NULL").unionByName(rest).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), F.col("n").alias("group_size"), (F.col("row") == F.col("best.row")).alias("kept"), "digest", "row"
    )
