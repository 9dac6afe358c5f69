"""Fill-in-the-middle transformation, cut by an indexable skip list.

A text is a sequence of units: code points, or the matches of a pattern from left to right, each with the signs before it
that no match holds; signs after the last match are one more unit. Over the units lies a skip list. Its lowest lane has
every unit, each lane above about one in eight of the lane below, and every link carries how many units and how many code
points it passes over. The place of a cut is found from the top lane down by adding up widths, without a look at the
units passed over, and gives the exact code point.

A null text is empty. Empty texts, and those that hold a mark themselves, stay plain. A text's cuts depend on its doc_id
alone, so repeated rows get the same result; a null doc_id counts as an empty one. Very long texts take eight bytes a unit of
a pattern, and four bytes a unit for the lanes.
An empty table gives no rows, and columns of the documents may have any names.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Marks before prefix, suffix and middle. Fixed values.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
RESULT = "n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
#: A node is in the next lane if so many bits of its hash are zero.
LANE_BITS = 3
MIX = np.uint64(0x9E3779B97F4A7C15)
#: A lane of up to so many nodes has no lane above it; nodes that are hashed at a time.
TOP, CHUNK = 16, 1 << 16


class SkipList:
    """Units by their rank. ``ends``: for each unit, how many code points it and those before it have; a range if each has one.

    The lowest lane is ``ends`` itself; ``lanes`` are those above it, each with its links' widths in units and in code points and
    its nodes' places in the lane below."""

    def __init__(self, ends: np.ndarray | range):
        self.ends, self.units = ends, len(ends)
        self.chars = int(ends[-1]) if len(ends) else 0
        self.lanes: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        # a node is the number of units before it; the list's head is node 0, its end the last
        nodes = np.concatenate([_promoted(np.arange(at, min(at + CHUNK, self.units + 1)), 0, self.units) for at in range(0, self.units + 1, CHUNK)])
        places = nodes
        while self.units > TOP and (not self.lanes or len(nodes) < len(self.lanes[-1][0]) + 1):
            before = nodes if isinstance(ends, range) else np.where(nodes > 0, ends[nodes - 1], 0)
            self.lanes.append((np.diff(nodes), np.diff(before), places))
            if len(nodes) <= TOP:
                return
            above = _promoted(nodes, len(self.lanes), self.units)
            places = np.searchsorted(nodes, above)
            nodes = above

    def chars_before(self, rank: int) -> int:
        """Code points of the first ``rank`` units."""
        units = chars = at = 0
        for unit_widths, char_widths, places in reversed(self.lanes):
            while at < len(unit_widths) and units + unit_widths[at] <= rank:
                units += int(unit_widths[at])
                chars += int(char_widths[at])
                at += 1
            at = int(places[at])
        while units < rank:
            chars += int(self.ends[units]) - (int(self.ends[units - 1]) if units else 0)
            units += 1
        return chars


def _promoted(nodes: np.ndarray, lane: int, last: int) -> np.ndarray:
    """Of a lane's nodes those that are in the next one too: about one in eight by a hash, and the ends."""
    mixed = (nodes.astype(np.uint64) * MIX) >> np.uint64(20 + lane * LANE_BITS)
    return nodes[((mixed & np.uint64((1 << LANE_BITS) - 1)) == 0) | (nodes == 0) | (nodes == last)]


def unit_ends(text: str, pattern: re.Pattern | None) -> np.ndarray | range:
    """Where the units of a text end, in code points; without a pattern every code point is one."""
    if pattern is None:
        return range(1, len(text) + 1)
    ends = array("q", (m.end() for m in pattern.finditer(text) if m.end() > m.start()))
    if text and (not ends or ends[-1] < len(text)):
        ends.append(len(text))
    return np.frombuffer(ends, np.int64) if ends else np.array([], np.int64)


@dataclass(frozen=True)
class Shares:
    """Percent of the texts that are transformed, and of these the percent in suffix-prefix-middle order."""

    transformed: int = 90
    spm: int = 20


def transformed(text: str | None, draws: tuple[int, int, int, int], shares: Shares, pattern: re.Pattern | None = None):
    """(units, form, code points of prefix and middle or None, output) of a text. ``draws`` are four random numbers: for the two
    cuts, for whether to transform, for the order."""
    text = text or ""
    units = SkipList(unit_ends(text, pattern))
    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or draws[2] % 100 >= shares.transformed:
        return units.units, PLAIN, None, None, text
    low, high = sorted(d % (units.units + 1) for d in draws[:2])
    a, b = units.chars_before(low), units.chars_before(high)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if draws[3] % 100 < shares.spm:
        return units.units, SPM, a, b - a, SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    return units.units, PSM, a, b - a, PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle


def restored(output: str, form: str) -> str:
    """The text that was transformed. As it holds no mark, the first of each kind is the one put there."""
    if form == PLAIN:
        return output
    first, second = (PREFIX, SUFFIX) if form == PSM else (SUFFIX, PREFIX)
    one, rest = output[len(first) :].split(second, 1)
    two, middle = rest.split(MIDDLE, 1)
    return one + middle + two if form == PSM else two + middle + one


def draws(key: Column, seed: int = 1) -> Column:
    """Four random numbers below 2**32 of a document, from its key and a seed."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)])


def fill_in_middle(text: Column, key: Column, seed: int = 1, shares: Shares = Shares(), pattern: str | None = None) -> Column:
    """A struct of n (units), form, prefix_chars, middle_chars (null if plain) and output."""
    fields = pa.struct([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])
    compiled = _compiled(pattern)

    def each(texts: pa.Array, numbers: pa.Array) -> pa.Array:
        units = compiled()
        made = [transformed(t.as_py(), n, shares, units) for t, n in zip(texts, numbers.to_pylist(), strict=True)]
        return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made, strict=True), fields, strict=True)] if made else [pa.array([], f.type) for f in fields], fields=list(fields))

    return F.arrow_udf(each, RESULT, F.ArrowUDFType.SCALAR)(text, draws(key, seed))


def restore(output: Column, form: Column) -> Column:
    """The text of before, from what ``fill_in_middle`` made of it."""

    def each(outputs: pa.Array, forms: pa.Array) -> pa.Array:
        return pa.array([restored(o.as_py(), f.as_py()) for o, f in zip(outputs, forms, strict=True)], pa.string())

    return F.arrow_udf(each, "string", F.ArrowUDFType.SCALAR)(output, form)


def _compiled(pattern: str | None) -> Callable[[], re.Pattern | None]:
    return lambda: None if pattern is None else re.compile(pattern)
