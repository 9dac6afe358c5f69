from __future__ import annotations

import random

import pytest

from brute import frame, plain_words
from tallyline.llm.substring_dedup import remove_repeats


def expected(rows, window):
    """(doc_id, n_words, n_removed, kept); a window counts as seen from its least (doc_id, start)."""
    least = {}
    low = lambda d: -(1 << 63) if d is None else d
    for d, t in rows:
        w = plain_words(t)
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            least[k] = min(least.get(k, (low(d), i)), (low(d), i))
    out = []
    for d, t in rows:
        w = plain_words(t)
        gone = set()
        for i in range(len(w) - window + 1):
            if least[tuple(w[i : i + window])] < (low(d), i):
                gone |= set(range(i, i + window))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def made(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("window", [2, 5, 20])
def test_against_brute_force(spark, window):
    dice = random.Random(window)
    rows = []
    passage = " ".join(dice.choice("abcdefgh") + str(dice.randrange(30)) for _ in range(60))
    for d in range(60):
        words = [dice.choice("abc") + str(dice.randrange(3 if d % 3 else 40)) for _ in range(dice.randrange(0, 90))]
        at = dice.randrange(len(words) + 1)
        rows.append((d * 7 % 60, " \n".join(words[:at]) + (f"\t{passage} " if d % 4 == 0 else " ") + "  ".join(words[at:])))
    rows += [(100, rows[5][1]), (101, rows[5][1]), (102, None), (103, ""), (104, " \n\t"), (None, rows[6][1]), (105, passage * 3)]
    rows += [rows[7], rows[7], (rows[8][0], rows[9][1])]
    got = made(remove_repeats(frame(spark, rows), window, group_bytes=500, bucket_hashes=200))
    assert got == sorted(expected(rows, window), key=str)


def test_spans_are_maximal(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = remove_repeats(frame(spark, [(1, text), (2, "new start " + text + " new end")])).collect()
    assert {r["doc_id"]: [(s["start"], s["stop"]) for s in r["spans"]] for r in rows} == {1: [], 2: [(2, 52)]}


def test_very_long_text_and_empty_table(spark):
    long = " ".join(f"n{i}" for i in range(200_000))
    rows = {r["doc_id"]: r["n_removed"] for r in remove_repeats(frame(spark, [(3, long), (2, long)])).select("doc_id", "n_removed").collect()}
    assert rows == {2: 0, 3: 200_000}
    assert remove_repeats(frame(spark, [])).collect() == []
