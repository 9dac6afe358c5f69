"""Benchmark decontamination with suffix arrays of the training texts.

Each slice of documents is a shard. Its words are numbered by the benchmark's own vocabulary; a word that no benchmark
item has ends a stretch, and a stretch shorter than the shortest window can't hold one. The suffixes that are left are
sorted by their first window (a suffix array of places), and every distinct window of the benchmark is looked up by binary
search: the suffixes that start with it are its occurrences. Matches are followed beyond the window on the numbers
themselves, so an item or a document costs bytes in proportion to its words, however long it is.

The documents stay where they are read: nothing is shuffled, and no document, source or passage can be hot. Only the
benchmark is sent to the tasks, in blocks of at most ``BLOCK_WORDS`` words that Spark writes to the shared folder. A task
holds up to ``KEPT_BLOCKS`` of them; of more it reads one after the other for every ``ROUND_BYTES`` of text. A longer item
is a block of its own: cut, it would lose the length of matches that run over the cut.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.frames import scratch_path, slices
from tallyline.llm.token_shards import _filesystem

WINDOW = 10
#: Words of the benchmark that are sent to the tasks at a time; about 50 bytes each, and those of the vocabulary.
BLOCK_WORDS = 1_000_000
#: A-Z lower-cased; every other ASCII sign but letters and digits separates words.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
#: Ends an item; no word has this number, nor zero.
END = 0xFFFFFFFF
#: Windows of the benchmark that are looked up at a time, and numbers compared at a time.
CHUNK = 1 << 18
#: Blocks that a worker keeps, and the bytes of text that it holds against all blocks at a time if there are more.
KEPT_BLOCKS, ROUND_BYTES = 3, 64 << 20
_PREPARED: dict[str, "Block"] = {}
FOUND = "struct<n_words:bigint,hits:array<struct<start:int,stop:int>>,items:array<bigint>,longest:int>"


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(FOLD).split()


class Block:
    """Some benchmark items: their vocabulary, their words as numbers in one line, and the places of their windows, sorted."""

    def __init__(self, items: Iterable[tuple[int | None, str]], window: int):
        self.window, self.vocabulary, self.ids, self.shortest = window, {}, [], window
        lines, starts, at = [np.array([END], np.uint32)], {}, 1
        for item, text in items:
            found = words(text)
            if not found:
                continue
            numbers = np.fromiter((self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in found), np.uint32, len(found))
            size = min(window, len(numbers))
            starts.setdefault(size, []).append((at, at + len(numbers) - size + 1, len(self.ids)))
            self.ids.append(item)
            self.shortest = min(self.shortest, size)
            lines += [numbers, np.array([END], np.uint32)]
            at += len(numbers) + 1
        self.line = np.concatenate(lines)
        self.windows = [_Windows(self.line, size, spans) for size, spans in sorted(starts.items())]

    def search(self, texts: list[str | None]) -> list[tuple[int, list[tuple[int, int]], set[int], int]]:
        """Of each text its number of words, the stretches hit, the items with windows in it, and its longest match."""
        known, shortest, width = self.vocabulary, self.shortest, self.window
        numbers = [np.fromiter((known.get(w, 0) for w in words(t)), np.uint32) for t in texts]
        out = [(len(n), [], set(), 0) for n in numbers]
        everything = np.concatenate([np.append(n, 0) for n in numbers] + [np.zeros(width, np.uint32)]).astype(np.uint32)
        ends = np.cumsum([len(n) + 1 for n in numbers])
        breaks = np.flatnonzero(everything == 0)
        ahead = breaks[np.searchsorted(breaks, np.arange(ends[-1]))] - np.arange(ends[-1])
        places = np.flatnonzero(ahead >= shortest)
        if not len(places) or not self.windows:
            return out
        # the suffix array of the shard: places sorted by their first window
        keys = _keys(everything, places, width, width)
        order = np.argsort(keys)
        keys, places = keys[order], places[order]
        covered, longest, of_doc = np.zeros(len(everything) + 1, np.int64), {}, {}
        for windows in self.windows:
            at, number = windows.occurrences(self.line, keys, places, width)
            np.add.at(covered, at, 1)
            np.add.at(covered, at + windows.size, -1)
            docs = np.searchsorted(ends, at, "right")
            for doc, n in np.unique(np.stack([docs, number], 1), axis=0).tolist():
                of_doc.setdefault(doc, set()).update(self.ids[i] for i in windows.items(n) if self.ids[i] is not None)
            before = np.where(at > 0, everything[at - 1], 0)
            # a match that can be longer to the left is no longest one
            first = (windows.left_low[number] != before) | (windows.left_high[number] != before)
            for place, n, doc, left in zip(at[first].tolist(), number[first].tolist(), docs[first].tolist(), before[first].tolist(), strict=True):
                if ahead[place] > longest.get(doc, 0):
                    starts = windows.places[windows.bounds[n] : windows.bounds[n + 1]]
                    starts = starts[self.line[starts - 1] != left]
                    longest[doc] = max(longest.get(doc, 0), self._shared(starts, everything[place : place + ahead[place]], windows.size))
        inside = np.diff(np.concatenate([[0], (np.cumsum(covered) > 0).astype(np.int8)]))
        hits: dict[int, list[tuple[int, int]]] = {}
        for start, stop in zip(np.flatnonzero(inside == 1).tolist(), np.flatnonzero(inside == -1).tolist(), strict=True):
            doc = int(np.searchsorted(ends, start, "right"))
            begin = int(ends[doc - 1]) if doc else 0
            hits.setdefault(doc, []).append((start - begin, stop - begin))
        for doc, found in hits.items():
            out[doc] = out[doc][0], found, of_doc[doc], longest[doc]
        return out

    def _shared(self, starts: np.ndarray, stretch: np.ndarray, size: int) -> int:
        """How many words at most the stretch shares with what starts at one of the places; ``size`` are known to be shared."""
        step = 16
        while size < len(stretch):
            n, going = min(step, len(stretch) - size), []
            best = 0
            for part in np.array_split(starts, len(starts) * n // CHUNK + 1):
                at = np.minimum(part[:, None] + np.arange(size, size + n), len(self.line) - 1)
                differs = self.line[at] != stretch[size : size + n]
                whole = ~differs.any(axis=1)
                going.append(part[whole])
                if len(part):
                    best = max(best, int(np.where(whole, n, differs.argmax(axis=1)).max()))
            starts, size, step = np.concatenate(going), size + best, min(2 * step, CHUNK)
            if not len(starts):
                return size
        return size


class _Windows:
    """The places of all windows of one size, sorted; where each distinct one begins among them; what stands before them."""

    def __init__(self, line: np.ndarray, size: int, spans: list[tuple[int, int, int]]):
        self.size = size
        places = np.concatenate([np.arange(a, b, dtype=np.int64) for a, b, _ in spans])
        owners = np.repeat(np.array([i for _, _, i in spans], np.int64), [b - a for a, b, _ in spans])
        order = np.lexsort([line[places + k] for k in reversed(range(size))])
        self.places, self.owners = places[order], owners[order]
        new = np.zeros(len(places), bool)
        new[0] = True
        for k in range(size):
            column = line[self.places + k]
            new[1:] |= column[1:] != column[:-1]
        starts = np.flatnonzero(new)
        self.bounds = np.append(starts, len(places))
        before = line[self.places - 1]
        self.left_low, self.left_high = np.minimum.reduceat(before, starts), np.maximum.reduceat(before, starts)

    def items(self, number: int) -> list[int]:
        owners = self.owners[self.bounds[number] : self.bounds[number + 1]]
        return owners.tolist() if len(owners) == 1 else np.unique(owners).tolist()

    def occurrences(self, line: np.ndarray, keys: np.ndarray, places: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The places of the shard where a window occurs, and the window's number."""
        at, number = [np.array([], np.int64)], [np.array([], np.int64)]
        for start in range(0, len(self.bounds) - 1, CHUNK):
            first = self.places[self.bounds[start : min(start + CHUNK, len(self.bounds) - 1)]]
            low = np.searchsorted(keys, _keys(line, first, self.size, width))
            high = np.searchsorted(keys, _keys(line, first, self.size, width, END), "right")
            counts = high - low
            hit = np.flatnonzero(counts)
            counts = counts[hit]
            within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            at.append(places[np.repeat(low[hit], counts) + within])
            number.append(np.repeat(hit + start, counts))
        return np.concatenate(at), np.concatenate(number)


def _keys(line: np.ndarray, places: np.ndarray, size: int, width: int, rest: int = 0) -> np.ndarray:
    """``size`` numbers from each place on, then ``rest`` up to ``width``, as byte strings that sort as the numbers do."""
    out = np.full((len(places), width), rest, ">u4")
    for k in range(size):
        out[:, k] = line[places + k]
    return out.view(f"S{4 * width}")[:, 0]


def _merged(hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, stop in sorted(hits):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], stop)
        else:
            out.append((start, stop))
    return out


def _blocks(benchmark: DataFrame, most: int) -> list[str]:
    """Folders in the shared folder with the items in blocks of few words. The driver sees their numbers alone."""
    spark, size = benchmark.sparkSession, F.floor(F.length("text") / 2) + 1
    total = benchmark.agg(F.sum(size).alias("n")).first()["n"]
    if total is None:
        return []

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = TaskContext.get().partitionId() << 32, 0
        for batch in slices(batches, 1):
            numbers = []
            for text in batch.column(1):
                n = len(text.as_py()) // 2 + 1
                if held and held + n > most:
                    block, held = block + 1, 0
                held += n
                numbers.append(block)
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), *batch.columns], ["block", "item", "text"])

    path = scratch_path(spark, "benchmark")
    dealt = benchmark.repartition(math.ceil(total / most)).mapInArrow(number, "block bigint, item bigint, text string")
    dealt.write.partitionBy("block").parquet(path)
    written = spark.read.schema("item bigint, text string, block bigint").parquet(path)
    return [f"{path}/block={r['block']}" for r in written.select("block").distinct().orderBy("block").collect()]


def _items(path: str) -> Iterator[tuple[int | None, str]]:
    files, folder = _filesystem(path)
    for file in files.get_file_info(pa.fs.FileSelector(folder)):
        if file.path.endswith(".parquet"):
            with files.open_input_file(file.path) as stream:
                for batch in pa.parquet.ParquetFile(stream).iter_batches(64, columns=["item", "text"]):
                    for item, text in zip(*batch.columns, strict=True):
                        yield item.as_py(), text.as_py()


def search(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text", item: str = "item_id", block_words: int = BLOCK_WORDS, into: str = "found") -> DataFrame:
    """The documents with a struct column ``into``: n_words; hits, the stretches of words inside an occurrence of a window
    of the benchmark; items, those with a window in the document; longest, the longest verbatim match in words.

    A window is ``window`` words of an item, or a shorter item as a whole. Null and empty texts have no words and no hits,
    items without words no windows; repeated documents or items count each; empty tables give no rows or no hits; an item
    with a null id hits words like any other and is left out of ``items``. All columns of the documents are kept, but for one named as ``into``, which is replaced.
    """
    items = benchmark.select(F.col(f"`{item}`").cast("bigint").alias("item"), F.col("text").alias("text")).where("text IS NOT NULL")
    return docs.withColumn(into, _pass(_blocks(items, block_words), window)(F.col(f"`{text}`")))


def _pass(paths: list[str], window: int):
    def prepared(path: str) -> Block:
        """A worker prepares a block once for all its tasks, if there are few."""
        name = f"{path} {window}"
        if name not in _PREPARED:
            while len(_PREPARED) >= KEPT_BLOCKS:
                _PREPARED.pop(next(iter(_PREPARED)))
            _PREPARED[name] = Block(_items(path), window)
        return _PREPARED[name]

    def searched(texts: list[pa.Array]) -> Iterator[pa.Array]:
        parts = [part.column(0).to_pylist() for one in texts for part in slices([pa.RecordBatch.from_arrays([one], ["text"])], 0)]
        found: list[list] = [[None] * len(part) for part in parts]
        if not paths:
            found = [[_joined((len(words(t)), [], set(), 0), None) for t in part] for part in parts]
        for path in paths:
            block = prepared(path)
            found = [[_joined(new, old) for new, old in zip(block.search(part), before, strict=True)] for part, before in zip(parts, found, strict=True)]
        rows, at = [r for part in found for r in part], 0
        for one in texts:
            yield pa.array(rows[at : at + len(one)], kind)
            at += len(one)

    def look(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held: list[pa.Array] = []
        size = 0
        for texts in batches:
            held.append(texts)
            size += texts.nbytes
            if len(paths) <= KEPT_BLOCKS or size >= ROUND_BYTES:
                yield from searched(held)
                held, size = [], 0
        if held:
            yield from searched(held)

    kind = pa.struct([("n_words", pa.int64()), ("hits", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))), ("items", pa.list_(pa.int64())), ("longest", pa.int32())])
    return F.arrow_udf(look, FOUND, F.ArrowUDFType.SCALAR_ITER)


def _joined(new: tuple, old: dict | None) -> dict:
    n, hits, items, longest = new
    if old is not None:
        hits = _merged(hits + [(h["start"], h["stop"]) for h in old["hits"]])
        items, longest = items | set(old["items"]), max(longest, old["longest"])
    return {"n_words": n, "hits": [{"start": a, "stop": b} for a, b in hits], "items": sorted(items), "longest": longest}


def n_hit(found: str = "found"):
    return F.aggregate(f"{found}.hits", F.lit(0).cast("bigint"), lambda a, h: a + (h["stop"] - h["start"]))


def decontaminated(docs: DataFrame, benchmark: DataFrame, item: str = "item_id", **settings) -> DataFrame:
    """The documents without a hit, with their own columns (one named __found is not kept)."""
    return search(docs, benchmark, item=item, into="__found", **settings).where(F.size("__found.hits") == 0).drop("__found")
