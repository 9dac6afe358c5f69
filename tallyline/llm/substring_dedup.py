"""Exact substring dedup over words by fixed-block anchors.

A window of ``window`` words is repeated if its words also start earlier: in a smaller doc_id, or earlier in the same one.
Each word that a repeated window covers is removed.

1. Anchors. Every document is cut into blocks of half a window that don't overlap; a repeated window holds a whole block
   of its earlier copy. All blocks are indexed, and every rolling window of block length probes the index. Only values
   travel: 32 bits of a hash beside its bucket, once for each group of documents, sorted and packed.
2. Extension. Around each hit, and nowhere else, the full windows are compared by 96 bits; of each the earliest place is
   found. Runs of windows that are not the earliest are the maximal exact repeats.
3. Removal, where the texts are.

Documents are dealt to groups of bounded size by a hash of key and text, so a hot source or a large group of copies is
spread. What a passage costs in its bucket is one entry for each group of documents, not one for each copy, and copies
are never paired.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.frames import narrow, shuffle_partitions, total_bytes

WINDOW = 20
#: Bytes of text of a group of documents, and hashes of a bucket, about.
GROUP_BYTES, BUCKET_HASHES = 4 << 20, 1 << 22
NULL_KEY = -(1 << 63)
BASES = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
REMOVED = "doc_id bigint, n_words bigint, n_removed bigint, spans array<struct<start:bigint,stop:bigint>>, kept string"


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _rolled(words: np.ndarray, n: int, base: np.uint64) -> np.ndarray:
    """A polynomial of each run of n words, by the run's start."""
    size = len(words) - n + 1
    out = np.zeros(max(size, 0), np.uint64)
    for k in range(n if size > 0 else 0):
        out = out * base + words[k : k + size]
    return out


class Group:
    """The words of some documents, one document after the other."""

    def __init__(self, keys: list[int | None], texts: list[str | None]):
        self.keys = keys
        self.words = [(t or "").encode().split() for t in texts]
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.ends = np.cumsum(self.sizes)
        digest = xxhash.xxh3_64_intdigest
        self.hashes = np.fromiter((digest(w) for words in self.words for w in words), np.uint64, int(self.sizes.sum()))
        self.start = np.arange(len(self.hashes)) - np.repeat(self.ends - self.sizes, self.sizes)
        self.left = np.repeat(self.ends, self.sizes) - np.arange(len(self.hashes))

    def anchors(self, block: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the runs of block length that lie in one document, and their hashes."""
        at = np.flatnonzero(self.left >= block)
        return at, _mixed(_rolled(self.hashes, block, BASES[0]))[at] if len(at) else np.array([], np.uint64)

    def windows(self, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
        """The full windows at some places: 64 bits, and 32 more."""
        if not len(at):
            return np.array([], np.uint64), np.array([], np.uint32)
        check = _mixed(_rolled(self.hashes, window, BASES[1]))[at] >> np.uint64(32)
        return _mixed(_rolled(self.hashes, window, BASES[0]))[at], check.astype(np.uint32)

    def order(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """doc_id and start of places."""
        keys = np.array([NULL_KEY if k is None else k for k in self.keys], np.int64)
        return np.repeat(keys, self.sizes)[at], self.start[at]


def _pack(*columns: np.ndarray) -> bytes:
    """Columns by byte planes, so that what varies little is together."""
    planes = b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1).T.tobytes() for c in columns)
    return zstandard.ZstdCompressor(level=1).compress(planes)


def _unpack(data: bytes, n: int, *kinds: type) -> list[np.ndarray]:
    raw, at, out = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8), 0, []
    for kind in kinds:
        width = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(raw[at : at + width * n].reshape(width, n).T).view(kind).reshape(n))
        at += width * n
    return out


def _gaps(values: np.ndarray) -> np.ndarray:
    return np.diff(values, prepend=values.dtype.type(0))


def _by_bucket(hashes: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """The buckets of sorted hashes: their first bits."""
    if not len(hashes):
        return
    buckets = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    starts = np.flatnonzero(np.diff(buckets, prepend=-1))
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(hashes)], strict=True):
        yield int(buckets[a]), slice(a, b)


def _table(rows: list[tuple], *names: str) -> pa.Table:
    kinds = {"bucket": pa.int64(), "g": pa.int64(), "n": pa.int64(), "packed": pa.binary()}
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.table([pa.array(c, kinds[n]) for c, n in zip(columns, names, strict=True)], names=list(names))


def _group_of(table: pa.Table) -> Group:
    return Group(table["doc_id"].to_pylist(), table["text"].to_pylist())


def _indexed(group: Group, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places of probes, which of the distinct hashes each has, the distinct hashes sorted, and their flags: bit 0 if one is
    a block, bit 1 if it stands at several places."""
    at, hashes = group.anchors(block)
    distinct, which, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    flags = 2 * (counts > 1).astype(np.uint8)
    flags[which[group.start[at] % block == 0]] |= 1
    return at, which, distinct, flags


def _probes(block: int, bits: int):
    def send(table: pa.Table) -> pa.Table:
        _, _, distinct, flags = _indexed(_group_of(table), block)
        g, rest = table["g"][0].as_py(), ((distinct << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)
        rows = [(b, g, s.stop - s.start, _pack(_gaps(rest[s]), flags[s])) for b, s in _by_bucket(distinct, bits)]
        return _table(rows, "bucket", "g", "n", "packed")

    return send


def _hits(table: pa.Table) -> pa.Table:
    """In a bucket, of each group the hashes that stand twice or more and once at least as a block: one bit for each."""
    sizes = table["n"].to_pylist()
    parts = [_unpack(p, n, np.uint32, np.uint8) for p, n in zip(table["packed"].to_pylist(), sizes, strict=True)]
    values = np.concatenate([np.cumsum(gaps, dtype=np.uint32) for gaps, _ in parts])
    flags = np.concatenate([f for _, f in parts])
    order = np.argsort(values, kind="stable")
    begins = np.flatnonzero(np.concatenate([[True], values[order][1:] != values[order][:-1]]))
    counts = np.add.reduceat(1 + (flags[order] >> 1).astype(np.int64), begins)
    anchored = np.bitwise_or.reduceat(flags[order], begins) & 1
    hit = np.empty(len(values), bool)
    hit[order] = np.repeat((counts > 1) & (anchored == 1), np.diff(np.append(begins, len(values))))
    ends = np.cumsum(sizes).tolist()
    own = [hit[e - n : e] for e, n in zip(ends, sizes, strict=True)]
    bucket = table["bucket"][0].as_py()
    rows = [(bucket, g, n, _pack(np.packbits(h))) for g, n, h in zip(table["g"].to_pylist(), sizes, own, strict=True) if h.any()]
    return _table(rows, "bucket", "g", "n", "packed")


def _candidates(window: int, block: int, bits: int):
    def send(table: pa.Table, found: pa.Table) -> pa.Table:
        if not len(table) or not len(found):
            return _table([], "bucket", "g", "n", "packed")
        group = _group_of(table)
        at, which, distinct, _ = _indexed(group, block)
        hit = np.zeros(len(distinct), bool)
        answers = {b: (n, p) for b, n, p in zip(*(found[c].to_pylist() for c in ("bucket", "n", "packed")), strict=True)}
        for bucket, s in _by_bucket(distinct, bits):
            if bucket in answers:
                n, packed = answers[bucket]
                hit[s] = np.unpackbits(_unpack(packed, -(-n // 8), np.uint8)[0])[:n].astype(bool)
        probes = np.zeros(len(group.hashes) + 1, np.int64)
        probes[at[hit[which]] + 1] = 1
        seen = np.cumsum(probes)
        places = np.flatnonzero(group.left >= window)
        places = places[seen[places + window - block + 1] > seen[places]]
        hashes, checks = group.windows(places, window)
        keys, starts = group.order(places)
        order = np.lexsort((starts, keys, checks, hashes))
        hashes, checks, keys, starts = hashes[order], checks[order], keys[order], starts[order].astype(np.int32)
        first = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (checks[1:] != checks[:-1])]) if len(hashes) else np.array([], bool)
        several = np.diff(np.append(np.flatnonzero(first), len(hashes))) > 1
        hashes, checks, keys, starts = hashes[first], checks[first], keys[first], starts[first]
        g = table["g"][0].as_py()
        rows = [(b, g, s.stop - s.start, _pack(_gaps(hashes[s]), checks[s], keys[s], starts[s], several[s])) for b, s in _by_bucket(hashes, bits)]
        return _table(rows, "bucket", "g", "n", "packed")

    return send


def _firsts(table: pa.Table) -> pa.Table:
    """In a bucket, the windows of each group that stand elsewhere too, and whether the earliest place of each is in it."""
    sizes = table["n"].to_pylist()
    parts = [_unpack(p, n, np.uint64, np.uint32, np.int64, np.int32, bool) for p, n in zip(table["packed"].to_pylist(), sizes, strict=True)]
    hashes = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts])
    checks, keys, starts, several = (np.concatenate([p[i] for p in parts]) for i in range(1, 5))
    order = np.lexsort((starts, keys, checks, hashes))
    h, c, k, s = hashes[order], checks[order], keys[order], starts[order]
    begins = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (c[1:] != c[:-1])]))
    counts = np.diff(np.append(begins, len(h)))
    repeated, first = np.empty(len(h), bool), np.empty(len(h), bool)
    repeated[order] = np.repeat(counts > 1, counts)
    first[order] = (k == np.repeat(k[begins], counts)) & (s == np.repeat(s[begins], counts))
    keep = repeated | several
    ends, rows, bucket = np.cumsum(sizes).tolist(), [], table["bucket"][0].as_py()
    for g, e, n in zip(table["g"].to_pylist(), ends, sizes, strict=True):
        own = slice(e - n, e)
        picked = keep[own]
        if picked.any():
            rows.append((bucket, g, int(picked.sum()), _pack(_gaps(hashes[own][picked]), checks[own][picked], first[own][picked])))
    return _table(rows, "bucket", "g", "n", "packed")


def _removal(window: int):
    def cut(table: pa.Table, found: pa.Table) -> pa.Table:
        group = _group_of(table) if len(table) else Group([], [])
        gone = np.zeros(len(group.hashes) + 1, np.int64)
        places = np.flatnonzero(group.left >= window)
        if len(found) and len(places):
            parts = [_unpack(p, n, np.uint64, np.uint32, bool) for p, n in zip(found["packed"].to_pylist(), found["n"].to_pylist(), strict=True)]
            known = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts])
            checks, first = (np.concatenate([p[i] for p in parts]) for i in (1, 2))
            order = np.lexsort((checks, known))
            known, checks, first = known[order], checks[order], first[order]
            hashes, own_checks = group.windows(places, window)
            at = np.searchsorted(known, hashes)
            # of equal 64 bits, the place with equal further bits
            match = np.full(len(hashes), -1)
            open_ = np.arange(len(hashes))
            while len(open_):
                open_ = open_[at[open_] < len(known)]
                open_ = open_[known[at[open_]] == hashes[open_]]
                same = checks[at[open_]] == own_checks[open_]
                match[open_[same]] = at[open_[same]]
                open_ = open_[~same]
                at[open_] += 1
            repeated = np.flatnonzero(match >= 0)
            keys, starts = group.order(places[repeated])
            order = np.lexsort((starts, keys, match[repeated]))
            m, k, s = match[repeated][order], keys[order], starts[order]
            begins = np.flatnonzero(np.concatenate([[True], m[1:] != m[:-1]])) if len(m) else np.array([], int)
            counts = np.diff(np.append(begins, len(m)))
            earliest = first[m] & (k == np.repeat(k[begins], counts)) & (s == np.repeat(s[begins], counts))
            removed = places[repeated][order][~earliest]
            np.add.at(gone, removed, 1)
            np.add.at(gone, removed + window, -1)
        keep = np.cumsum(gone)[:-1] == 0
        spans, kept, n_removed, at = [], [], [], 0
        for words in group.words:
            own = keep[at : at + len(words)]
            at += len(words)
            edges = np.flatnonzero(np.diff(np.concatenate([[True], own, [True]]))).tolist()
            spans.append([{"start": a, "stop": b} for a, b in zip(edges[::2], edges[1::2], strict=True)])
            n_removed.append(int(len(own) - own.sum()))
            kept.append(b" ".join(compress(words, own.tolist()) if edges else words).decode())
        kinds = {"doc_id": pa.int64(), "n_words": pa.int64(), "n_removed": pa.int64(), "spans": pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])), "kept": pa.string()}
        columns = group.keys, group.sizes, n_removed, spans, kept
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], names=list(kinds))

    return cut


def remove_repeats(docs: DataFrame, window: int = WINDOW, text: str = "text", key: str = "doc_id", group_bytes: int = GROUP_BYTES, bucket_hashes: int = BUCKET_HASHES) -> DataFrame:
    """doc_id, n_words, n_removed, spans (stretches of removed words, from 0) and kept (the kept words joined by one space).

    Null, empty and blank texts have no words. A null key is the smallest. Rows that share a key are compared by where
    their windows start: of equal starts each is kept, so repeated rows are cut alike. An empty table gives none; other
    columns are not carried.
    """
    if window < 2:
        raise ValueError("a window has two words at least")
    spark, block = docs.sparkSession, window // 2
    rows = narrow(docs, doc_id=key, text=text).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    size, tasks = total_bytes(rows, "text"), shuffle_partitions(spark)
    groups = max(2 * tasks, size // group_bytes + 1)
    bits = max(1, int(max(tasks, size // 6 // bucket_hashes)).bit_length())
    dealt = rows.withColumn("g", F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups))).repartition(tasks, "g")
    packed = "bucket bigint, g bigint, n bigint, packed binary"
    by_group = lambda df: df.groupBy("g")
    probes = by_group(dealt).applyInArrow(_probes(block, bits), packed)
    hits = probes.groupBy("bucket").applyInArrow(_hits, packed)
    candidates = by_group(dealt).cogroup(by_group(hits)).applyInArrow(_candidates(window, block, bits), packed)
    firsts = candidates.groupBy("bucket").applyInArrow(_firsts, packed)
    return by_group(dealt).cogroup(by_group(firsts)).applyInArrow(_removal(window), REMOVED)
