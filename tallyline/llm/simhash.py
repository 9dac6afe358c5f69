"""SimHash near-duplicates through segment popcounts.

A fingerprint's 64 bits are 32 segments of two bits; its embedding is the vector of their bit counts (0 to 2). The
Manhattan distance of two embeddings is never above the fingerprints' bit distance, so a grid over embeddings finds
every pair: the segments are dealt to groups such that a pair within the allowed distance is at most two apart in one
group, and then it shares one of the grid cells at most one step from each. A fingerprint enters about 25 cells in each
group, whatever the number of documents. Pairs in a cell are then verified by their exact bit distance.

Only distinct fingerprints are compared. A cell passes on a spanning forest of its links, never all its pairs. A cell
too large for a task is dealt out again as pairs of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.components import components
from tallyline.llm.frames import kept_table, narrow, shuffle_partitions

SEED, SEGMENTS = 42, 32
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
ODD_BITS = np.uint64(0x5555555555555555)
#: Fingerprints of a cell that one task compares with each other at most.
CELL_ROWS = 50_000
#: Cells up to this size are compared together, larger ones each for itself.
SMALL_CELL = 64


def fingerprint(text: str | None, shingle: int) -> int:
    """As signed 64-bit integer. A bit is set if it is in over half of the shingles' hashes; no words: zero."""
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        shingles = [line]
    else:
        ends = np.cumsum([len(w) + 1 for w in words]).tolist()
        shingles = [line[a : b - 1] for a, b in zip([0, *ends], ends[shingle - 1 :], strict=False)]
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64, len(shingles))
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(shingles), bitorder="little").view(np.int64)[0])


def fingerprints(text: Column, shingle: int) -> Column:
    def each(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t.as_py(), shingle) for t in texts], pa.int64())

    return F.arrow_udf(each, "bigint", F.ArrowUDFType.SCALAR)(text)


def cells(prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """(cell, fingerprint) pairs: of each group of segments the own cell and those one step away."""
    counts = (prints & ODD_BITS) + ((prints >> np.uint64(1)) & ODD_BITS)  # two bits for each segment
    groups = np.array_split(np.arange(SEGMENTS), distance // 3 + 1)
    found, owners = [], []
    for number, segments in enumerate(groups):
        first, n = int(segments[0]), len(segments)
        own = (counts >> np.uint64(2 * first)) & np.uint64((1 << (2 * n)) - 1)
        top = np.uint64(number) * np.uint64(0x9E3779B97F4A7C15)  # cells of different groups get different numbers
        found.append(own ^ top)
        owners.append(prints)
        for s in range(n):
            step = np.uint64(1 << (2 * s))
            lane = (own >> np.uint64(2 * s)) & np.uint64(3)
            for near, moved in ((lane < 2, own + step), (lane > 0, own - step)):
                found.append(moved[near] ^ top)
                owners.append(prints[near])
    return np.concatenate(found), np.concatenate(owners)


def links(prints: DataFrame, distance: int, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(a, b): enough links between distinct fingerprints (``fp``) to join all that a chain of links joins."""

    def into_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, fp = cells(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), distance)
            for at in range(0, len(cell), 1 << 16):
                part = slice(at, at + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(cell[part].view(np.int64)), pa.array(fp[part].view(np.int64))], ["cell", "fp"])

    compare = _comparison(distance, cell_rows)
    n = shuffle_partitions(prints.sparkSession)
    dealt = prints.select("fp").mapInArrow(into_cells, "cell bigint, fp bigint")
    rows = dealt.repartition(n, "cell").sortWithinPartitions("cell")
    found = kept_table(rows.mapInArrow(compare, "a bigint, b bigint, rows bigint"), "links")
    large = found.where("rows > 0").select(F.col("a").alias("cell"), F.ceil(2 * F.col("rows") / cell_rows).cast("int").alias("blocks"))
    out = found.where("rows = 0").select("a", "b")
    if large.isEmpty():
        return out
    spread = dealt.join(large, "cell").withColumn("own", F.pmod(F.xxhash64("fp"), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    pairs = spread.select("cell", "fp", "own", other.alias("other"), "blocks")
    # a number for the unordered pair of blocks
    low, high = F.least("own", "other"), F.greatest("own", "other")
    pairs = pairs.select(F.xxhash64("cell", low, high).alias("cell"), "fp")
    again = pairs.repartition(n, "cell").sortWithinPartitions("cell")
    more = again.mapInArrow(_comparison(distance, 1 << 62), "a bigint, b bigint, rows bigint")
    return out.union(kept_table(more.where("rows = 0").select("a", "b"), "links"))


def _comparison(distance: int, cell_rows: int):
    """Rows sorted by cell in; a spanning forest of each cell's links out, and (cell, 0, rows) for a cell that is too large."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_cells, held_prints, skipped, count = [], [], None, 0
        for batch in _end(batches):
            if batch is not None:
                cell = batch.column(0).to_numpy(zero_copy_only=False)
                fp = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
                if skipped is not None:  # the rest of a cell that is too large
                    rest = int(np.searchsorted(cell, skipped, "right"))
                    count += rest
                    cell, fp = cell[rest:], fp[rest:]
                    if not len(cell):
                        continue
                    yield _edges([skipped], [0], [count])
                    skipped = None
                held_cells.append(cell)
                held_prints.append(fp)
            elif skipped is not None:
                yield _edges([skipped], [0], [count])
            if not held_cells:
                continue
            cell, fp = np.concatenate(held_cells), np.concatenate(held_prints)
            whole = len(cell) if batch is None else int(np.searchsorted(cell, cell[-1]))
            a, b = _forest(cell[:whole], fp[:whole], distance)
            if len(a):
                yield _edges(a.view(np.int64), b.view(np.int64), np.zeros(len(a), np.int64))
            held_cells, held_prints = [cell[whole:]], [fp[whole:]]
            if len(cell) - whole > cell_rows:
                skipped, count = int(cell[-1]), len(cell) - whole
                held_cells, held_prints = [], []

    return compare


def _end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _edges(a, b, rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(rows, pa.int64())], ["a", "b", "rows"])


def _forest(cell: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else np.array([], int)
    sizes = np.diff(np.append(starts, len(cell)))
    size_of = np.repeat(sizes, sizes)
    small = (size_of > 1) & (size_of <= SMALL_CELL)
    c, f = cell[small], fp[small]
    left, right = [], []
    for lag in range(1, SMALL_CELL):
        near = np.flatnonzero(c[lag:] == c[:-lag]) if lag < len(c) else []
        if not len(near):
            break
        near = near[np.bitwise_count(f[near] ^ f[near + lag]) <= distance]
        left.append(f[near])
        right.append(f[near + lag])
    for start, size in zip(starts[sizes > SMALL_CELL].tolist(), sizes[sizes > SMALL_CELL].tolist(), strict=True):
        rest = np.unique(fp[start : start + size])
        while len(rest):
            reached, rest = rest[:1], rest[1:]
            while len(reached) and len(rest):
                close = np.bitwise_count(rest ^ reached[0]) <= distance
                left.append(np.full(int(close.sum()), reached[0]))
                right.append(rest[close])
                reached, rest = np.concatenate([reached[1:], rest[close]]), rest[~close]
    if not left:
        return np.array([], np.uint64), np.array([], np.uint64)
    return _spanning(np.concatenate(left), np.concatenate(right))


def _spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node with the least node that its links reach, the links being these alone."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[i], label[j])
        after = label.copy()
        np.minimum.at(after, i, low)
        np.minimum.at(after, j, low)
        np.minimum.at(after, label[i], low)
        np.minimum.at(after, label[j], low)
        after = after[after]
        if (after == label).all():
            break
        label = after
    moved = label != np.arange(len(nodes))
    return nodes[label[moved]], nodes[moved]


def near_duplicates(docs: DataFrame, shingle: int, distance: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, fp (as signed integer) and component_id, the smallest doc_id that links reach, of each document.

    Null, empty and blank texts have fingerprint zero and link like any other. A null doc_id is never the smallest unless
    there is no other; repeated rows are rows of one class; an empty table gives none; other columns are not carried.
    """
    prints = kept_table(narrow(docs, doc_id=key, text=text).select("doc_id", fingerprints(F.col("text"), shingle).alias("fp")), "prints")
    members = _members(prints, distance)
    least = members.groupBy("root").agg(F.min("least").alias("component_id"))
    named = members.join(least, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def _members(prints: DataFrame, distance: int) -> DataFrame:
    """Each distinct fingerprint with the least doc_id that has it and its component's root, the least fingerprint of it."""
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(classes, distance))
    joined = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    return kept_table(joined, "members")


def hex_digits(fp: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def representatives(docs: DataFrame, shingle: int, distance: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One document of each component, with its own columns: the one with the smallest doc_id. Documents are told apart by
    doc_id and fingerprint, so ids that are null or used again neither join components nor keep further rows of one. A
    column named __fp is not kept."""
    # written once: the fingerprints are not made again where the texts are picked
    printed = kept_table(docs.withColumn("__fp", fingerprints(docs[f"`{text}`"], shingle)), "printed")
    prints = printed.select(F.col(f"`{key}`").alias("doc_id"), F.col("__fp").alias("fp"))
    first = F.min(F.struct(F.col("least").isNull().alias("lost"), "least", "fp")).alias("first")
    chosen = _members(prints, distance).groupBy("root").agg(first).select(F.col("first.least").alias("least"), F.col("first.fp").alias("own"))
    same = (F.col("fp") == F.col("own")) & F.col("doc_id").eqNullSafe(F.col("least"))
    stays = kept_table(prints.join(chosen, same).groupBy("least", "own").agg(F.count("*").alias("n")), "stays")

    def among(n: str) -> DataFrame:
        # the ids grow with the documents, so they are never broadcast: texts are shuffled once at every size
        ids = stays.where(n).hint("merge")
        return printed.join(ids, (printed["__fp"] == ids["own"]) & printed[f"`{key}`"].eqNullSafe(ids["least"]), "left_semi")

    # one fingerprint is chosen of each component, so rows that share it are rows of one component
    return among("n = 1").unionByName(among("n > 1").dropDuplicates(["__fp"])).drop("__fp")
