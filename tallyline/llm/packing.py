"""Best-fit packing: documents as token sequences of a fixed room, packed online with a fixed number of open sequences.

Each task keeps at most ``open_bins`` open sequences. An integer used as a bitset has bit f set if an open sequence has f
free places; the smallest set bit that is not below a piece's length is the best fit. When one more is opened than
allowed, the fullest closes first. Documents are packed where they are read, whatever their source, so no key can be hot.

A task leaves at most ``open_bins`` sequences open. Their pieces, without texts and ids unless these are asked for, are
dealt to so few tasks that each has ``SECOND_SEQUENCES`` to fill if there are as many, and packed once more in the same
way, the longest first: how many sequences there are does not depend on how many tasks read the documents.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tallyline.llm.frames import kept_table, narrow, slices
from tallyline.llm.piecewise import REMEMBERED, encoder

ROOM = 4096
OPEN_BINS = 512
#: Sequences' worth of left pieces that a task packs at the second time; rows that a task hands on at a time.
SECOND_SEQUENCES, ROWS = 20_000, 10_000
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"


class OpenBins:
    """The open sequences of one task. place() says where a piece goes: the sequence's number and the offset in it; ``closed``
    has the numbers of those that have closed since it was last emptied."""

    def __init__(self, room: int, most: int):
        self.room, self.most, self.open, self.next = room, most, 0, 0
        self.closed: list[int] = []
        self.free, self.by_free = 0, [[] for _ in range(room + 1)]

    def place(self, length: int) -> tuple[int, int]:
        fitting = self.free >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            number = self._take(space)
        else:
            space, number = self.room, self.next
            self.next += 1
            if self.open == self.most:
                self.closed.append(self._take((self.free & -self.free).bit_length() - 1))  # the fullest closes
        if space == length:
            self.closed.append(number)
        else:
            self.by_free[space - length].append(number)
            self.free |= 1 << (space - length)
            self.open += 1
        return number, self.room - space

    def _take(self, space: int) -> int:
        number = self.by_free[space].pop()
        if not self.by_free[space]:
            self.free ^= 1 << space
        self.open -= 1
        return number


def pack(
    docs: DataFrame, tokenizer: str, end_id: int, spaces_kept: bool = False, room: int = ROOM, open_bins: int = OPEN_BINS,
    text: str = "text", key: str = "doc_id", with_ids: bool = False, remembered: int = REMEMBERED,
) -> DataFrame:
    """One row for each piece of each document: its place in the document, in a sequence, and a checksum of its ids
    (``with_ids``: and the ids). A worker remembers the ids of ``remembered`` pieces of text. Only documents longer than ``room`` are cut, into pieces of ``room`` and a last shorter
    one.

    Null and empty texts are the end id alone; a null key stays null; repeated rows are packed each for itself; an empty
    table gives none; pieces of equal length go to the sequence opened last among equally full ones; other columns are
    not looked at. What the tasks give is written to the shared folder before pieces that they left are packed again.
    """
    schema = T.StructType.fromDDL(PIECES)
    schema["doc_id"].dataType = docs.schema[key].dataType
    if with_ids:
        schema = schema.add("ids", T.BinaryType())
    end = end_id.to_bytes(4, "little")

    with_left = T.StructType([*schema.fields, T.StructField("left", T.BooleanType())])
    kinds = [to_arrow_type(docs.schema[key].dataType), pa.int32(), *[pa.int64()] * 5, *[pa.binary()] * with_ids]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, encode = OpenBins(room, open_bins), encoder(tokenizer, spaces_kept, remembered).encode
        first = TaskContext.get().partitionId() << 40
        held: dict[int, list[tuple]] = {}
        done: list[tuple] = []

        def batch(left: bool) -> pa.RecordBatch:
            columns = [pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays([*columns, pa.array([left] * len(done), pa.bool_())], with_left.names)

        for rows in slices(batches, 1):
            for doc, ids in zip(rows.column(0).to_pylist(), encode(rows.column(1).to_pylist()), strict=True):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * room)):
                    part = ids[at : at + 4 * room]
                    number, offset = bins.place(len(part) // 4)
                    held.setdefault(number, []).append((doc, piece, at // 4, len(part) // 4, zlib.crc32(part), first + number, offset, *[part] * with_ids))
                    while bins.closed:
                        done += held.pop(bins.closed.pop())
                if len(done) >= ROWS:
                    yield batch(False)
                    done = []
        if done:
            yield batch(False)
        for number in list(held):
            done = held.pop(number)
            yield batch(True)

    def packed_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, first = OpenBins(room, open_bins), (1 << 62) + (TaskContext.get().partitionId() << 40)
        for batch in batches:
            places = [bins.place(n) for n in batch.column("length").to_pylist()]
            bins.closed.clear()
            new = {"sequence_id": [first + n for n, _ in places], "offset": [at for _, at in places]}
            yield pa.RecordBatch.from_arrays([pa.array(new[n], pa.int64()) if n in new else batch.column(n) for n in schema.names], schema.names)

    once = kept_table(narrow(docs, key=key, text=text).mapInArrow(packed, with_left), "pieces")
    left = once.where("left").drop("left")
    tokens = left.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("n")).first()["n"]
    # a piece has a hash of its own unless its document is repeated, and then the start of a sequence is a place to tell it by
    dealt = left.repartition(max(1, math.ceil(tokens / (room * SECOND_SEQUENCES))), F.xxhash64("doc_id", "piece", "sequence_id", "offset"))
    again = dealt.sortWithinPartitions(F.desc("length"), "doc_id", "piece", "ids_crc32").mapInArrow(packed_again, schema)
    return once.where("NOT left").drop("left").unionByName(again)
