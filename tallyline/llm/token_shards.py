"""Token ids on disk: a Spark data source of shard files in the Zstandard seekable format.

A shard holds independent zstandard frames, each with the ids of some whole documents (little-endian unsigned 32-bit),
then a skippable frame with the index of its documents, then the seek table: a skippable frame with each frame's
compressed size, size and checksum (low 32 bits of XXH64) and a fixed footer. Any zstandard decoder reads the ids; a
reader that wants some documents decompresses the frames that hold them only.

Writing is a Spark write: each task attempt writes a file under its own name, and the commit lists the files of the
attempts that succeeded, so tasks may be repeated. Text reaches the files in ascending key order if the frame that is
written is sorted so (``write_tokens`` does that).
"""

from __future__ import annotations

import json
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from tallyline.llm.frames import narrow, slices
from tallyline.llm.piecewise import encoder

FORMAT = "token_shards"
MANIFEST = "manifest.json"
#: Ids of a frame before it is closed; one document is never split.
FRAME_IDS = 1 << 16
#: Fixed values of the Zstandard seekable format.
INDEX_MAGIC, SEEK_MAGIC, FOOTER_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
WITH_CHECKSUMS = 0x80
NULL_KEY = -(1 << 63)


def _filesystem(uri: str) -> tuple[pa.fs.FileSystem, str]:
    if "://" in uri or uri.startswith("file:"):
        return pa.fs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri)
    return pa.fs.LocalFileSystem(), uri


class ShardWriter:
    """Writes one shard to an open binary stream."""

    def __init__(self, stream, level: int = 1):
        self.stream, self.packer = stream, zstandard.ZstdCompressor(level=level, write_checksum=False)
        self.held, self.held_bytes, self.index, self.seek, self.ids = [], 0, [], [], 0

    def add(self, key: int | None, ids: bytes) -> None:
        self.index.append((NULL_KEY if key is None else key, len(ids) // 4, len(self.seek)))
        self.held.append(ids)
        self.held_bytes += len(ids)
        self.ids += len(ids) // 4
        if self.held_bytes >= 4 * FRAME_IDS:
            self._close_frame()

    def _close_frame(self) -> None:
        raw = b"".join(self.held)
        frame = self.packer.compress(raw)
        self.stream.write(frame)
        self.seek.append((len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.held, self.held_bytes = [], 0

    def finish(self) -> None:
        if self.held:
            self._close_frame()
        index = self.packer.compress(np.array(self.index, "<i8").reshape(-1, 3).T.tobytes())
        self.stream.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        table = b"".join(struct.pack("<III", *entry) for entry in [*self.seek, (8 + len(index), 0, 0)])
        footer = struct.pack("<IBI", len(self.seek) + 1, WITH_CHECKSUMS, FOOTER_MAGIC)
        self.stream.write(struct.pack("<II", SEEK_MAGIC, len(table) + 9) + table + footer)


class ShardFile:
    """Reads one shard from an open random-access file: the seek table and index first, frames on demand."""

    def __init__(self, file):
        self.file, size = file, file.size()
        count, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != FOOTER_MAGIC or not flags & WITH_CHECKSUMS:
            raise ValueError("not a shard of token ids: no seek table at its end")
        self.seek = list(struct.iter_unpack("<III", self._at(size - 9 - 12 * count, 12 * count)))
        self.starts = np.cumsum([0, *[s[0] for s in self.seek]]).tolist()
        packed = self._at(self.starts[count - 1] + 8, self.seek[-1][0] - 8)
        self.keys, self.lengths, self.frames = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), "<i8").reshape(3, -1)

    def _at(self, start: int, n: int) -> bytes:
        self.file.seek(start)
        return self.file.read(n)

    def frame(self, i: int) -> bytes:
        packed, size, checksum = self.seek[i]
        raw = zstandard.ZstdDecompressor().decompress(self._at(self.starts[i], packed), max_output_size=size)
        if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {i} of a token shard is damaged: its checksum differs")
        return raw

    def documents(self, wanted: set[int] | None) -> Iterator[tuple[int | None, int, bytes]]:
        """Key, ids before it in the shard, and ids, of all documents or of those wanted."""
        before = np.concatenate([[0], np.cumsum(self.lengths)])
        picked = np.ones(len(self.keys), bool) if wanted is None else np.isin(self.keys, list(wanted))
        for i in np.unique(self.frames[picked]).tolist():
            raw, inside = self.frame(i), np.flatnonzero(self.frames == i)
            base = before[inside[0]]
            for d in inside[picked[inside]].tolist():
                at = 4 * int(before[d] - base)
                yield (None if self.keys[d] == NULL_KEY else int(self.keys[d])), int(before[d]), raw[at : at + 4 * int(self.lengths[d])]


@dataclass
class Written(WriterCommitMessage):
    part: int
    name: str
    ids: int
    documents: int
    first: int
    last: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.tokenizer = options["path"], options["tokenizer"]
        self.spaces_kept = options.get("spaceskept", "true") == "true"
        self.end = int(options["endid"]).to_bytes(4, "little")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        part, name = TaskContext.get().partitionId(), f"{uuid.uuid4().hex}.tokens.zst"
        files, folder = _filesystem(self.path)
        files.create_dir(folder, recursive=True)
        encode, keys = encoder(self.tokenizer, self.spaces_kept).encode, []
        with files.open_output_stream(f"{folder}/{name}", compression=None) as stream:
            shard = ShardWriter(stream)
            for batch in slices(iterator, 1):
                for key, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist()), strict=True):
                    shard.add(key, ids + self.end)
            shard.finish()
        keys = [k for k, _, _ in shard.index]
        return Written(part, name, shard.ids, len(keys), min(keys, default=0), max(keys, default=0))

    def commit(self, messages: list[Written | None]) -> None:
        files, folder = _filesystem(self.path)
        listed = sorted((m for m in messages if m is not None and m.documents), key=lambda m: m.part)
        with files.open_output_stream(f"{folder}/{MANIFEST}", compression=None) as stream:
            stream.write(json.dumps([vars(m) for m in listed]).encode())

    def abort(self, messages: list[Written | None]) -> None:
        files, folder = _filesystem(self.path)
        for m in messages:
            if m is not None:
                files.delete_file(f"{folder}/{m.name}")


@dataclass
class Shard(InputPartition):
    name: str
    before: int


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.wanted = set(json.loads(options["docids"])) if "docids" in options else None

    def partitions(self) -> list[Shard]:
        files, folder = _filesystem(self.path)
        with files.open_input_file(f"{folder}/{MANIFEST}") as stream:
            listed = json.loads(stream.read())
        starts = np.cumsum([0, *[m["ids"] for m in listed]]).tolist()
        held = zip(listed, starts, strict=False)
        return [Shard(m["name"], s) for m, s in held if self.wanted is None or any(m["first"] <= w <= m["last"] for w in self.wanted)]

    def read(self, partition: Shard | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # there is no shard to read
            return
        files, folder = _filesystem(self.path)
        rows, held = [], 0
        with files.open_input_file(f"{folder}/{partition.name}") as file:
            for key, before, ids in ShardFile(file).documents(self.wanted):
                rows.append((key, partition.before + before, len(ids) // 4, ids))
                held += len(ids)
                if held > 4 << 20:
                    yield self._batch(rows)
                    rows, held = [], 0
        if rows:
            yield self._batch(rows)

    @staticmethod
    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        keys, starts, lengths, ids = zip(*rows, strict=True)
        kinds = pa.int64(), pa.int64(), pa.int64(), pa.binary()
        columns = [pa.array(c, k) for c, k in zip((keys, starts, lengths, ids), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids"])


class TokenShards(DataSource):
    """Options: path; to write, tokenizer (its file), endId, spacesKept; to read, docIds (a JSON list: only these)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "doc_id bigint, start bigint, n_tokens bigint, ids binary"

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options)

    def reader(self, schema) -> _Reader:
        return _Reader(self.options)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, spaces_kept: bool = True, text: str = "text", key: str = "doc_id") -> None:
    """Writes the ids of every text, each with the end id, in ascending key order.

    Null and empty texts are the end id alone. A null key comes first. Rows that share a key stand side by side, ordered
    by their texts' hashes; all are written. An empty table gives an empty manifest. Other columns are not written.
    """
    docs.sparkSession.dataSource.register(TokenShards)
    rows = narrow(docs, key=key, text=text).withColumn("key", F.col("key").cast("bigint"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("key", "tie").sortWithinPartitions("key", "tie").select("key", "text")
    ordered.write.format(FORMAT).mode("append").options(path=path, tokenizer=tokenizer, endId=end_id, spacesKept=str(spaces_kept).lower()).save()


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """Of each document its key, the ids of all documents before it, the number of its ids, and its ids as bytes."""
    spark.dataSource.register(TokenShards)
    reader = spark.read.format(FORMAT).option("path", path)
    return (reader if doc_ids is None else reader.option("docIds", json.dumps(doc_ids))).load()
