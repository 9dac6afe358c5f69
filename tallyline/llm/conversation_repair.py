"""Repair of conversations to alternating turns by cheapest edits, found by iterative-deepening A*.

A repaired conversation is empty, or an optional system turn followed by pairs of a user and an assistant turn; only the
first letters of roles count. Each row is kept (0), given the role that fits (3) or deleted (4), and turns without text may be
inserted anywhere (3). Blank rows and repeated messages must be deleted; a row whose text does not end a sentence costs 3
more if it stays. An audit is the edits' initials in order; of the cheapest the least in ASCII order is taken.

The search is depth-first in ASCII order of edits under a cost bound, which rises to the least cost that might succeed. A
table of failed states (row, state of the grammar) keeps what each needs at least, so a state is entered again only with a
larger budget. Once the bound is the least cost, the first accepting path is the least audit. Long conversations are
searched in blocks of ``BLOCK_ROWS``: a block's paths are judged by their cost and what the blocks after it cost from where
they end. Insertions count to the row that they stand before, so no path of a block is a prefix of another and the blocks'
least audits make up the whole one.

For Spark, equal rows combine before the first shuffle, and repeated messages are found by their first turn, joined on
keys that are unique. Rows without their texts are then dealt out in order, so that a very long conversation lies on
several tasks; a task solves whole conversations, and of one that may go on elsewhere the best path between any two states
of the grammar. The paths are put together from these pieces, one a task. Only to write a conversation's
repaired text does one task read its rows in order, a batch at a time.

Nulls: a null role or text is one space, null turns come first, a null conv_id is a conversation of its own. Rows that
share a turn are ordered by role and digest of the text; equal rows are repeated messages. An empty role fits nowhere.
Texts may be very long. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tallyline.llm.frames import kept_table, narrow, shuffle_partitions, slices

SPACE = " \t\n\x0b\x0c\r"
USER, ASSISTANT = "user", "assistant"
#: States of the grammar: nothing yet, after system, after user, after assistant. What a row's role leads to, by its first
#: letter, and what an inserted or renamed turn does.
STEP = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
FILL = [2, 2, 3, 2]
#: What it costs, and takes, to end the conversation in a state.
END_COSTS, END_AUDITS = (0, 6, 3, 0), ("", "II", "I", "")
DELETE, INSERT, RENAME, UNFINISHED = 4, 3, 3, 3
NEVER = 1 << 60
#: Rows that are searched at a time.
BLOCK_ROWS = 64
#: A row as the search sees it: first letter of the role (or "-"), in upper case if it must be deleted.
GONE = "D"
LEGAL = ["su", "ua", "au"]

Rows = tuple[tuple[str, int], ...]
Path = tuple[int, str, int] | None


@lru_cache(maxsize=100_000)
def search(rows: Rows, entry: int, ends: tuple[int, ...]) -> Path:
    """(cost, audit, last state) of the cheapest edits of rows that start in a state of the grammar, ``ends`` being what it
    costs to go on from each state; None if there are none. A row is (first letter of its role, or GONE, and its surcharge)."""
    # deletions stay in a state; an insertion leads to user or assistant, and only a kept row from nothing to system
    reached = {entry, 2, 3} | ({1} if entry == 0 and any(letter == "s" for letter, _ in rows) else set())
    if all(ends[q] >= NEVER for q in reached):
        return None
    n = len(rows)
    floor = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        letter, extra = rows[i]
        floor[i] = floor[i + 1] + (DELETE if letter == GONE else min(DELETE, extra) if letter in "sua" else min(DELETE, extra + RENAME))
    rest = min(ends)
    needs = [[floor[i] + rest] * 4 for i in range(n)] + [list(ends)]

    def descend(i: int, state: int, budget: int) -> str | None:
        """The first path that fits the budget; else the state needs more, as ``needs`` then says."""
        nonlocal last
        if needs[i][state] > budget:
            return None
        if i == n:
            last = state
            return ""
        letter, extra = rows[i]
        # edits in ASCII order: letter, cost, next row, next state
        edits = [("D", DELETE, i + 1, state), ("I", INSERT, i, FILL[state])]
        if letter != GONE:
            if letter in STEP[state]:
                edits.append(("K", extra, i + 1, STEP[state][letter]))
            edits.append(("R", extra + RENAME, i + 1, FILL[state]))
        least = NEVER
        for edit, cost, to, after in edits:
            found = descend(to, after, budget - cost)
            if found is not None:
                return edit + found
            least = min(least, cost + needs[to][after])
        needs[i][state] = max(needs[i][state], least)
        return None

    last = entry
    while (path := descend(0, entry, bound := needs[0][entry])) is None:
        pass
    return bound, path, last


def solve(rows: Sequence[tuple[str, int]], entries: Sequence[int], ends: Sequence[int]) -> dict[int, Path]:
    """The same for any number of rows, by blocks from the last to the first; (cost, audit, last state) by entry."""
    costs = tuple(min(e, NEVER) for e in ends)
    chosen: list[list[Path]] = []
    starts = range(0, len(rows), BLOCK_ROWS)
    for start in reversed(starts):
        block = tuple(rows[start : start + BLOCK_ROWS])
        found = [search(block, q, costs) if start or q in entries else None for q in range(4)]
        costs = tuple(p[0] if p else NEVER for p in found)
        chosen.append(found)
    out: dict[int, Path] = {}
    for entry in entries:
        state, audit = entry, []
        for found in reversed(chosen):
            if found[state] is None:
                break
            audit.append(found[state][1])
            state = found[state][2]
        else:
            out[entry] = (costs[entry], "".join(audit), state) if costs[entry] < NEVER else None
    return {e: out.get(e) for e in entries}


def _grouped(batches: Iterator[pa.RecordBatch], text: int | None = None) -> Iterator[tuple[object, Iterator[dict]]]:
    """(key, rows) of rows that come sorted by their first column; a group's rows are to be used up before the next group is
    taken. ``text``: a column of long texts, of which a few MB are taken at a time."""

    def rows() -> Iterator[dict]:
        for batch in batches if text is None else slices(batches, text):
            yield from batch.to_pylist()

    return groupby(rows(), key=lambda r: r["conv"])


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 2000, most_chars: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, str))
        if len(held) >= most or size > most_chars:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def messages(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Distinct rows, in the shared folder: conv, turn, role, text, digest, copies, and what the text's end says: 'blank',
    'truncated' or ''."""
    own = narrow(rows, conv=conversation, turn=turn, role=role, text=text)
    own = own.withColumns({"role": F.coalesce("role", F.lit(" ")), "text": F.coalesce("text", F.lit(" "))})
    once = own.groupBy("conv", "turn", "role", "text").agg(F.count("*").alias("copies"))
    body = F.rtrim(F.col("text"), F.lit(SPACE))
    end = F.when(body == "", "blank").when(~F.right(body, F.lit(1)).isin(".", "!", "?"), "truncated").otherwise("")
    return kept_table(once.withColumns({"digest": F.unhex(F.sha2("text", 256)), "end": end}), "messages")


def judged(found: DataFrame) -> DataFrame:
    """The messages without their texts, and the first fault of each: 'blank', 'duplicate', 'truncated' or ''. All copies of a row
    but its first are duplicates too, unless blank."""
    slim = found.select("conv", "turn", "role", "digest", "copies", "end")
    first = F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("first")
    firsts = slim.groupBy("conv", "role", "digest").agg(first).select(
        F.col("conv").alias("c"), F.col("first.turn").alias("t"), F.col("role").alias("r"), F.col("digest").alias("d"), F.lit(True).alias("is_first")
    )
    on = F.col("conv").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    fault = F.when(F.col("end") == "blank", "blank").when(F.col("is_first").isNull(), "duplicate").otherwise(F.col("end"))
    return kept_table(slim.join(firsts, on, "left").withColumn("fault", fault).drop("c", "t", "r", "d", "is_first", "end"), "judged")


ORDER = ["conv", "turn", "role", "digest"]


def _pieces(rows: DataFrame, kind: str) -> DataFrame:
    """Of each conversation one row for each task that has rows of it: illegal neighbours, first and last letter, and the cheapest
    paths between states of the grammar; a conversation that lies on one task alone needs that from start to end only."""
    schema = f"conv {kind}, part int, illegal bigint, first string, last string, options array<struct<entry:int,exit:int,cost:bigint,audit:string>>, whole boolean"
    letter = F.when(F.col("role") == "", "-").otherwise(F.substring("role", 1, 1))
    slim = rows.select(*ORDER, letter.alias("letter"), "copies", "fault")
    dealt = slim.repartitionByRange(shuffle_partitions(rows.sparkSession), *ORDER).sortWithinPartitions(*ORDER).select("conv", "letter", "copies", "fault")

    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        out = None

        def flush(piece, whole: bool):
            conv, letters, codes = piece
            illegal = sum(a + b not in LEGAL for a, b in zip(letters, letters[1:], strict=False))
            ends = [(None, END_COSTS)] if whole else [(e, tuple(0 if e == q else NEVER for q in range(4))) for e in range(4)]
            options = [
                {"entry": entry, "exit": path[2], "cost": path[0], "audit": path[1]}
                for _, costs in ends
                for entry, path in solve(codes, (0,) if whole else range(4), costs).items()
                if path
            ]
            return _batch([(conv, part, illegal, letters[0], letters[-1], options, whole)], fields)

        number = 0
        held = None
        for conv, members in _grouped(batches):
            letters, codes = [], []
            for m in members:
                letters += [m["letter"]] * m["copies"]
                forced = m["fault"] in ("blank", "duplicate")
                codes.append((GONE if forced else m["letter"], UNFINISHED if m["fault"] == "truncated" else 0))
                codes += [(GONE, 0)] * (m["copies"] - 1)
            if held is not None:
                # only the first and the last conversation of a task can go on elsewhere
                yield flush(held, number > 1)
            held, number = (conv, letters, codes), number + 1
        if held is not None:
            yield flush(held, False)

    fields = pa.schema([
        ("conv", _arrow(rows, "conv")), ("part", pa.int32()), ("illegal", pa.int64()), ("first", pa.string()), ("last", pa.string()),
        ("options", pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))),
        ("whole", pa.bool_()),
    ])
    return dealt.mapInArrow(solved, schema)


def _arrow(df: DataFrame, column: str) -> pa.DataType:
    return to_arrow_type(df.schema[column].dataType)


def _joined(pieces: DataFrame, kind: str) -> DataFrame:
    """conv, illegal, cost, audit of whole conversations, from their pieces in order."""
    fields = pa.schema([("conv", _arrow(pieces, "conv")), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches((_whole(conv, list(parts)) for conv, parts in _grouped(batches)), fields)

    rows = pieces.repartition(shuffle_partitions(pieces.sparkSession), "conv").sortWithinPartitions("conv", "part")
    return rows.mapInArrow(joined, f"conv {kind}, illegal bigint, cost bigint, audit string")


def _whole(conv, parts: list[dict]) -> tuple:
    illegal = sum(p["illegal"] for p in parts) + sum(a["last"] + b["first"] not in LEGAL for a, b in zip(parts, parts[1:], strict=False))
    if parts[0]["whole"]:
        cost, audit, last = parts[0]["options"][0]["cost"], parts[0]["options"][0]["audit"], parts[0]["options"][0]["exit"]
        return conv, illegal, cost, audit + END_AUDITS[last]
    costs, best = list(END_COSTS), []
    for p in reversed(parts):
        ways: dict[int, tuple[int, str, int]] = {}
        for o in p["options"]:
            way = (o["cost"] + costs[o["exit"]], o["audit"], o["exit"])
            ways[o["entry"]] = min(ways.get(o["entry"], way), way)
        costs = [ways[q][0] if q in ways else NEVER for q in range(4)]
        best.append(ways)
    state, audit = 0, []
    for ways in reversed(best):
        audit.append(ways[state][1])
        state = ways[state][2]
    return conv, illegal, costs[0], "".join(audit) + END_AUDITS[state]


def repairs(found: DataFrame) -> DataFrame:
    """One row for each conversation with a row in ``found`` (``messages``): conv, gaps in its turns, blank, duplicate and
    truncated rows, illegal neighbours, the cost of the repair and its audit. ``gaps`` is null if it does not fit a long."""
    kind, rows_judged = found.schema["conv"].dataType.simpleString(), judged(found)
    audits = kept_table(_joined(kept_table(_pieces(rows_judged, kind), "pieces"), kind), "audits")
    turn = F.col("turn").cast("decimal(38,0)")
    gaps = F.coalesce(F.max(turn) - F.min(turn) + 1 - F.count_distinct("turn"), F.lit(0).cast("decimal(38,0)"))
    more = F.col("copies") - 1

    def rows(fault: str) -> Column:
        # the copies of a row that is not blank are duplicates, whatever the row itself is
        if fault == "duplicate":
            return F.sum(F.when(F.col("fault") == "duplicate", F.col("copies")).when(F.col("fault") != "blank", more).otherwise(0))
        return F.sum(F.when(F.col("fault") == fault, F.col("copies") if fault == "blank" else F.lit(1)).otherwise(F.lit(0)))

    counted = rows_judged.groupBy("conv").agg(
        gaps.try_cast("bigint").alias("gaps"), *[rows(f).cast("bigint").alias(f) for f in ("blank", "duplicate", "truncated")]
    )
    return counted.join(audits, counted["conv"].eqNullSafe(audits["conv"])).select(
        counted["conv"], "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"
    )


def repaired(found: DataFrame, audits: DataFrame) -> DataFrame:
    """The turns of the repaired conversations: conv, place (from 0), role, text, from their messages and audits. Rows come in
    order within each conversation, and a conversation's rows are all in one partition."""
    kind = found.schema["conv"].dataType.simpleString()
    none = lambda t: F.lit(None).cast(t)
    turn = found.schema["turn"].dataType
    rows = found.select("conv", F.lit(1).alias("kind"), "turn", "role", "digest", "text", "copies").union(
        audits.select("conv", F.lit(0), none(turn), none("string"), none("binary"), F.col("audit"), F.lit(1).cast("bigint"))
    )
    fields = pa.schema([("conv", _arrow(found, "conv")), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches((row for conv, members in _grouped(batches, text=5) for row in _edited(conv, members)), fields)

    dealt = rows.repartition(shuffle_partitions(found.sparkSession), "conv").sortWithinPartitions("conv", "kind", "turn", "role", "digest")
    return dealt.mapInArrow(edited, f"conv {kind}, place bigint, role string, text string")


def _edited(conv, members: Iterator[dict]) -> Iterator[tuple]:
    """The audit comes first, then the rows in order."""
    audit = next(members)["text"]
    at = place = state = 0

    def fill() -> str:
        return USER if FILL[state] == 2 else ASSISTANT

    def inserted() -> Iterator[tuple]:
        nonlocal at, place, state
        while at < len(audit) and audit[at] == "I":
            yield conv, place, fill(), ""
            at, place, state = at + 1, place + 1, FILL[state]

    for m in members:
        for _ in range(m["copies"]):
            yield from inserted()
            edit, at = audit[at], at + 1
            if edit == "D":
                continue
            role = m["role"] if edit == "K" else fill()
            yield conv, place, role, m["text"]
            place, state = place + 1, STEP[state][role[0]]
    yield from inserted()


def line_digests(turns: DataFrame) -> DataFrame:
    """(conv, sha256): of each conversation's ``role:text`` lines, in the order that ``repaired`` gives them."""
    kind = turns.schema["conv"].dataType.simpleString()
    fields = pa.schema([("conv", _arrow(turns, "conv")), ("sha256", pa.string())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            for conv, members in _grouped(batches, text=3):
                digest = hashlib.sha256()
                for m in members:
                    digest.update(f"{chr(10) if m['place'] else ''}{m['role']}:{m['text']}".encode())
                yield conv, digest.hexdigest()

        yield from _batches(each(), fields)

    return turns.mapInArrow(hashed, f"conv {kind}, sha256 string")


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults put in by the checksum of ``conv_id:turn``, nulls being one space: of twenty, one row is dropped,
    one loses its text, one its sentence ends, one is repeated, one becomes the user's."""
    plain = narrow(rows, conv_id="conv_id", turn="turn", role="role", text="text")
    conv, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    key = F.concat(conv, F.lit(":"), turn)
    what, text = F.crc32(key) % 20, F.coalesce("text", F.lit(" "))
    return plain.withColumn("what", what).where("what <> 0").select(
        "conv_id", "turn",
        F.when(F.col("what") == 4, USER).otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(F.col("what") == 1, "").when(F.col("what") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(F.col("what") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")
