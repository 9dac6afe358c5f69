from __future__ import annotations

import random
import re
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brute import frame
from tallyline.llm import fill_in_middle as fim

TEXTS = st.text(st.sampled_from("ab <>PSM\n\té🤦́"), max_size=60)
DRAWS = st.tuples(*[st.integers(0, 2**32 - 1)] * 4)


@settings(max_examples=300, deadline=None)
@given(TEXTS, DRAWS)
def test_round_trip(text, draws):
    n, form, a, b, output = fim.transformed(text, draws, fim.Shares())
    assert n == len(text) and fim.restored(output, form) == text
    low, high = sorted(d % (n + 1) for d in draws[:2])
    assert (form == fim.PLAIN) == (a is None) and (form == fim.PLAIN or (a, b) == (low, high - low))
    if form == fim.PSM:
        assert output == f"<P>{text[:low]}<S>{text[high:]}<M>{text[low:high]}"
    if form == fim.SPM:
        assert output == f"<S>{text[high:]}<P>{text[:low]}<M>{text[low:high]}"


@pytest.mark.parametrize("n", [0, 1, 15, 16, 17, 200, 5000, 100_000])
def test_skip_list_reaches_every_rank(n):
    dice = random.Random(n)
    widths = np.array([dice.randrange(1, 9) for _ in range(n)], np.int64)
    ends = np.cumsum(widths)
    held = fim.SkipList(ends)
    assert (held.units, held.chars) == (n, int(widths.sum()))
    for units, chars, _ in held.lanes:
        assert units.sum() == n and chars.sum() == widths.sum()
    assert all(len(a[0]) > len(b[0]) for a, b in zip(held.lanes, held.lanes[1:], strict=False))
    for rank in {0, n, n // 2, *[dice.randrange(n + 1) for _ in range(300)]}:
        assert held.chars_before(rank) == (int(ends[rank - 1]) if rank else 0)


def test_long_lists_have_few_links_to_follow():
    held = fim.SkipList(np.arange(1, 1_000_001))
    assert 4 <= len(held.lanes) <= 8 and len(held.lanes[-1][0]) <= fim.TOP
    assert held.chars_before(777_777) == 777_777


def test_very_long_texts_cost_few_bytes_a_sign():
    import tracemalloc

    text = "ab " * 1_000_000
    tracemalloc.start()
    n, form, a, b, output = fim.transformed(text, (123_456_789, 987_654_321, 5, 50), fim.Shares())
    assert (n, form) == (3_000_000, fim.PSM) and fim.restored(output, form) == text
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 12 * len(text)


@given(TEXTS, DRAWS)
def test_units_of_a_pattern(text, draws):
    words = re.compile(r"\S+")
    ends = fim.unit_ends(text, words).tolist()
    want = [m.end() for m in words.finditer(text)]
    assert ends == want + ([len(text)] if text and (not want or want[-1] < len(text)) else [])
    n, form, a, _, output = fim.transformed(text, draws, fim.Shares(), words)
    assert fim.restored(output, form) == text and n == len(ends)
    assert a is None or a in {0, *ends}


def test_column(spark):
    rows = [(1, None), (2, ""), (3, "a"), (None, "no id 🤦 here"), (4, "has <S> in it"), (5, "<P"), (5, "<P"), (6, "é" * 300_000), (7, "<" * 40)]
    rows += [(d, "".join(random.Random(d).choices("ab \n🤦", k=d))) for d in range(8, 120)]
    docs = frame(spark, rows)
    made = docs.select("doc_id", "text", "key", fim.fill_in_middle(F.col("text"), F.col("doc_id")).alias("found"))
    got = made.select("*", fim.restore(F.col("found.output"), F.col("found.form")).alias("back")).collect()
    assert len(got) == len(rows)
    forms = set()
    for r in got:
        text, f = r["text"] or "", r["found"]
        h = [int(sha256(f"1:{'' if r['doc_id'] is None else r['doc_id']}".encode()).hexdigest()[8 * i : 8 * i + 8], 16) for i in range(4)]
        assert r["back"] == text and f["n"] == len(text) and r["key"] == "x"
        plain = not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90
        assert f["form"] == ("plain" if plain else "spm" if h[3] % 100 < 20 else "psm")
        low, high = sorted(x % (len(text) + 1) for x in h[:2])
        assert (f["prefix_chars"], f["middle_chars"]) == ((None, None) if plain else (low, high - low))
        forms.add(f["form"])
    assert forms == {"plain", "spm", "psm"}
    assert made.where("false").collect() == []
    words = docs.select(fim.fill_in_middle(F.col("text"), F.col("doc_id"), seed=2, shares=fim.Shares(100, 100), pattern=r"\S+").alias("found"))
    assert {r["found"]["form"] for r in words.collect()} == {"plain", "spm"}
