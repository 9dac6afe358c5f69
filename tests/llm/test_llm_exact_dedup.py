from __future__ import annotations

import random
from hashlib import sha256

from brute import frame
from tallyline.llm import exact_dedup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows):
    """(doc_id, keep_id, group_size, digest) of each row, and how many rows stay of each text."""
    texts = [(t or "").translate(LOWER) for _, t in rows]
    groups = {}
    for (d, _), t in zip(rows, texts, strict=True):
        groups.setdefault(t, []).append(d)
    best = {t: max((d for d in ids if d is not None), default=None) for t, ids in groups.items()}
    return sorted(((d, best[t], len(groups[t]), sha256(t.encode()).digest()) for (d, _), t in zip(rows, texts, strict=True)), key=str)


def check(spark, rows, **parameters):
    found = exact_dedup.duplicates(frame(spark, rows), **parameters).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], bytes(r["digest"])) for r in found), key=str) == plain(rows)
    stays = [(bytes(r["digest"]), r["doc_id"], r["keep_id"]) for r in found if r["kept"]]
    assert len({s[0] for s in stays}) == len(stays) == len({p[3] for p in plain(rows)}) and all(d == k for _, d, k in stays)


ODD = [
    (1, None), (2, ""), (None, ""), (3, " "), (4, "É e"), (5, "é E"), (6, "É E"), (7, "K kelvin"), (8, "k kelvin"), (9, "AbC"), (9, "aBc"), (9, "aBc"),
    (None, "no id"), (None, "NO ID"), (10, "w " * 400_000 + "X"), (11, "W " * 400_000 + "x"), (12, "İ"), (13, "i̇"), (14, "tab\tA"), (15, "tab\ta"),
]


def test_odd_rows(spark):
    check(spark, ODD)
    check(spark, [])


def test_hot_groups_go_either_way_with_one_result(spark):
    dice = random.Random(3)
    rows = [(d, "Hot passage" if d % 3 == 0 else f"text {dice.randrange(700)}" if d % 3 == 1 else f"own {d}") for d in range(6000)]
    for counters in (2, 50, exact_dedup.COUNTERS):
        check(spark, rows, counters=counters)


def test_frequent_digests_are_found_and_few(spark):
    dice = random.Random(5)
    rows = [(d, f"t{int(dice.paretovariate(1.2))}") for d in range(8000)]
    sizes = {}
    for _, t in rows:
        sizes[t] = sizes.get(t, 0) + 1
    docs = frame(spark, rows).repartition(13)
    for counters in (4, 20, 200):
        digests = docs.select(exact_dedup.digest(docs["text"]).alias("digest"))
        got = {bytes(r["digest"]) for r in exact_dedup.frequent(digests, counters).collect()}
        want = {sha256(t.encode()).digest() for t, n in sizes.items() if n >= 2 * len(rows) / (counters + 1) and n > 1}
        assert want and want <= got and len(got) <= counters + 1


def test_documents_that_stay(spark):
    docs = frame(spark, ODD).withColumnsRenamed({"key": "digest", "words": "row", "g": "best", "fp": "n"})
    stays = exact_dedup.deduplicated(docs)
    assert stays.columns == docs.columns
    got = sorted(((r["text"] or "").translate(LOWER) for r in stays.collect()), key=str)
    assert got == sorted({(t or "").translate(LOWER) for _, t in ODD}, key=str)
    assert exact_dedup.deduplicated(docs.where("false")).collect() == []
