from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import components as plain_components
from brute import frame
from tallyline.llm import decontamination, languages, simhash
from tallyline.llm.components import components


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string, extra string")


def expected(docs, tests, window):
    windows = {}
    for i, t in tests:
        w = decontamination.words(t)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(i)
    out = []
    for d, t in docs:
        w, hit, found = decontamination.words(t), set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])] - {None}
        out.append((d, len(w), len(hit), sorted(found)))
    return out


@pytest.mark.parametrize("block_words", [8, 1_000_000])
def test_decontamination_against_brute_force(spark, block_words):
    dice = random.Random(3)
    some = lambda n: " ".join(dice.choice(["the", "of", "Ab", "c9", "é"]) for _ in range(n))
    tests = [(i, some(dice.randrange(0, 9))) for i in range(25)] + [(30, None), (None, "the of"), (31, ""), (1, some(6)), (32, "zz"), (33, "the_of, the! OF")]
    docs = [(d, some(dice.randrange(0, 40))) for d in range(40)]
    docs += [(50, None), (51, ""), (52, "x" + "-the" * 3), (None, "zz"), (3, "zz zz"), (3, "zz zz"), (53, "q " * 50_000 + "zz")]
    found = decontamination.search(frame(spark, docs), items(spark, [(i, t, "e") for i, t in tests]), window=4, block_words=block_words)
    got = [(r["doc_id"], r["found"]["n_words"], r["n"], r["found"]["items"]) for r in found.select("doc_id", "found", decontamination.n_hit().alias("n")).collect()]
    assert sorted(got, key=str) == sorted(expected(docs, tests, 4), key=str)
    assert "words" in found.columns


def test_longest_match_and_removal(spark):
    passage = " ".join(f"w{i}" for i in range(30))
    docs = frame(spark, [(1, f"so {passage[:60]} it is"), (2, "clean words"), (3, passage.upper())])
    tests = items(spark, [(1, passage, "e")])
    got = {r["doc_id"]: r["found"]["longest"] for r in decontamination.search(docs, tests).collect()}
    assert got == {1: 17, 2: 0, 3: 30}
    assert [r["doc_id"] for r in decontamination.decontaminated(docs, tests).collect()] == [2]


def test_longest_match_against_brute_force():
    dice = random.Random(8)
    some = lambda n: [dice.choice("abc") for _ in range(n)]
    tests = [some(dice.randrange(1, 60)) for _ in range(30)] + [["a"] * 50]
    docs = [some(dice.randrange(0, 90)) for _ in range(30)] + [["a"] * 120, ["x", *tests[3], "x", *tests[4]]]
    for window in (3, 6):
        got = decontamination.Block([(i, " ".join(t)) for i, t in enumerate(tests)], window).search([" ".join(d) for d in docs])
        for doc, (_, _, _, longest) in zip(docs, got, strict=True):
            shared = [n for t in tests for n in range(min(window, len(t)), len(t) + 1) for k in range(len(t) - n + 1) if "".join(t[k : k + n]) in "".join(doc)]
            assert longest == max(shared, default=0)


def test_long_items_cost_bytes_in_proportion():
    text = " ".join(f"w{i % 5000}" for i in range(8000))
    tracemalloc.start()
    got = decontamination.Block([(1, text)], 10).search(["so " + text, text[:600]])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(hits, longest) for _, hits, _, longest in got][0] == ([(1, 8001)], 8000) and got[1][2] == {1}
    assert peak < 10_000_000


def test_the_benchmark_does_not_pass_the_driver(spark, monkeypatch):
    tests = items(spark, [(i, f"only {i} some words of item", "e") for i in range(40)])
    monkeypatch.setattr(type(tests), "toLocalIterator", lambda *a, **b: pytest.fail("read by the driver"))
    found = decontamination.search(frame(spark, [(1, "so only 7 some words of item")]), tests, window=5, block_words=60)
    assert [(r["found"]["items"], r["found"]["longest"]) for r in found.collect()] == [([7], 6)]


def test_items_without_an_id_remove_documents(spark):
    docs = frame(spark, [(1, "so these are the words of it"), (2, "clean words")])
    left = decontamination.decontaminated(docs, items(spark, [(None, "these are the words", "e")]), window=4)
    assert [r["doc_id"] for r in left.collect()] == [2]


def test_empty_tables_have_no_hits(spark):
    none = items(spark, [])
    assert [r["found"]["hits"] for r in decontamination.search(frame(spark, [(1, "a b")]), none).collect()] == [[]]
    assert decontamination.search(frame(spark, []), none).collect() == []


def test_links_against_all_pairs(spark):
    dice = np.random.default_rng(5)
    base = dice.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = [b ^ np.bitwise_or.reduce(np.uint64(1) << dice.integers(0, 64, dice.integers(1, 8), dtype=np.uint64)) for b in base for _ in range(6)]
    chain = [base[0]]
    for _ in range(20):
        chain.append(chain[-1] ^ np.bitwise_or.reduce(np.uint64(1) << dice.choice(64, 4, replace=False).astype(np.uint64)))
    prints = sorted({int(x.view(np.int64)) for x in [*base, *flips, *chain, np.uint64(0), np.uint64(7)]})
    df = spark.createDataFrame([(p,) for p in prints], "fp bigint")
    for distance in (1, 4, 7):
        want = plain_components(prints, lambda a, b: ((a ^ b) & ((1 << 64) - 1)).bit_count() <= distance)
        for cell_rows in (simhash.CELL_ROWS, 3):
            got = {r["node"]: r["root"] for r in components(simhash.links(df, distance, cell_rows)).collect()}
            assert {p: got.get(p, p) for p in prints} == want


def test_a_crowded_cell_passes_on_few_links(spark):
    dice = np.random.default_rng(1)
    prints = {int((np.uint64(1 << 40) ^ np.bitwise_or.reduce(np.uint64(1) << dice.choice(64, 2, replace=False).astype(np.uint64))).view(np.int64)) for _ in range(600)}
    found = simhash.links(spark.createDataFrame([(p,) for p in prints], "fp bigint"), 4).collect()
    assert len(found) < 60 * len(prints)
    nodes = sorted(prints)
    assert len({*plain_components(nodes, lambda a, b: ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 4).values()}) == 1


def test_near_duplicates(spark):
    text = " ".join(f"word{i}" for i in range(300))
    rows = [(9, text), (2, text.upper()), (4, text + " more"), (5, None), (6, ""), (7, "a b"), (8, "a  b"), (None, "a b"), (11, "k"), (11, "k"), (12, "own words are here now")]
    got = sorted((r["doc_id"] or -1, r["component_id"]) for r in simhash.near_duplicates(frame(spark, rows), 4, 4).collect())
    assert got == [(-1, 7), (2, 2), (4, 2), (5, 5), (6, 5), (7, 7), (8, 7), (9, 2), (11, 11), (11, 11), (12, 12)]
    stays = simhash.representatives(frame(spark, rows), 4, 4)
    assert sorted(r["doc_id"] for r in stays.collect()) == [2, 5, 7, 11, 12] and "component_id" in stays.columns
    assert simhash.near_duplicates(frame(spark, []), 4, 4).collect() == []
    lost = simhash.representatives(frame(spark, [(None, "no key"), (None, "no key")]), 4, 4).collect()
    assert [(r["doc_id"], r["text"]) for r in lost] == [(None, "no key")]


def test_representatives_are_rows_not_ids(spark):
    text = lambda t: " ".join(f"{t}{i}" for i in range(60))
    rows = [(None, text("a")), (None, text("b")), (None, text("c")), (None, text("c")), (7, text("d")), (7, text("e")), (7, text("f")), (3, text("f"))]
    got = simhash.representatives(frame(spark, rows), 4, 4).collect()
    want = [(None, text("a")), (None, text("b")), (None, text("c")), (7, text("d")), (7, text("e")), (3, text("f"))]
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == sorted(want, key=str)
    # an id's row stays with its own component, though the id is the least of another
    one = [(1, text("g")), (0, text("h")), (1, text("h"))]
    assert sorted(r["text"][0] for r in simhash.representatives(frame(spark, one), 4, 4).collect()) == ["g", "h"]


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000), (500, 501), (501, 500)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {501: 500}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_languages_held_out(spark, smallest):
    folder = smallest.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = languages.fit(docs.where(~held))
    assert model.families == {"germanic": ["de", "en"], "romance": ["es", "fr"]}
    found = docs.where(held).select("lang", languages.predicted(model, spark, F.col("text")).alias("p")).collect()
    assert sum(r["lang"] == r["p"]["lang"] for r in found) >= 0.97 * len(found)
    assert all(0 <= r["p"]["score"] <= 1 for r in found)


def test_languages_of_odd_texts_and_labels(spark):
    rows = [(i, f"das ist der {i} text und", "de") for i in range(30)] + [(i, f"this is the {i} text and", "en") for i in range(30)]
    rows += [(90, None, "de"), (91, "the and", None), (92, "", "en"), (93, "123 !?", "en")]
    labelled = spark.createDataFrame(rows, "id int, text string, lang string")
    model = languages.fit(labelled)
    odd = frame(spark, [(1, None), (2, ""), (3, "12 + 3 = ??"), (4, "der und das"), (5, "the and this " * 100_000), (5, "的"), (None, "this is the")])
    got = {r["text"]: r["p"]["lang"] for r in odd.select("text", languages.predicted(model, spark, F.col("text")).alias("p")).collect()}
    assert (got[None], got[""], got["12 + 3 = ??"], got["der und das"], got["this is the"]) == ("und", "und", "und", "de", "en")
    assert got["的"] in ("de", "en")
    assert model.predict(["½ ² Ⅷ ① ⁴", "ª", "Ⅷ x"])[0] == ("und", 0.0) and "und" not in {p[0] for p in model.predict(["ª", "Ⅷ x"])}
    one = languages.fit(labelled.where("lang = 'de'"))
    assert one.predict(["abc", "1"]) == [("de", 1.0), ("und", 0.0)]
    none = languages.fit(labelled.where("lang = 'xx'"))
    assert none.predict(["abc"]) == [("und", 0.0)]
    assert frame(spark, []).select(languages.predicted(model, spark, F.col("text"))).collect() == []


def plain_margin(machine, text):
    """By definition: the mean weight of a text's byte sequences of each order, those that run over its end filled with zeros."""
    data = languages.letters(text)
    total = 0
    for k, order in enumerate(languages.ORDERS):
        for i in range(len(data)):
            h = 0
            for j, byte in enumerate((data[i:] + bytes(4))[:order]):
                h = (byte if j == 0 else h ^ byte) * 0x01000193 & 0xFFFFFFFF
            total += int(machine.weights[k][(h ^ (h >> 15)) & (languages.BUCKETS - 1)])
    return machine.bias + total / (languages.FIXED * len(data))


@pytest.fixture(scope="module")
def four_languages(spark, smallest):
    docs = spark.read.parquet(f"{smallest}/documents.parquet")
    return languages.fit(docs), [r["text"] for r in docs.select("text").orderBy("doc_id").limit(80).collect()]


def test_a_prediction_is_the_same_alone_and_in_any_batch(four_languages):
    model, texts = four_languages
    dice = random.Random(4)
    texts = [*texts, "de", "es ist", "é", None, "12", "a", "the und le", "x" * 100_000]
    alone = [model.predict([t])[0] for t in texts]
    for _ in range(5):
        order = dice.sample(range(len(texts)), len(texts))
        cut = dice.randrange(1, len(texts))
        together = model.predict([texts[i] for i in order[:cut]]) + model.predict([texts[i] for i in order[cut:]])
        assert together == [alone[i] for i in order]


def test_predictions_against_brute_force(four_languages):
    model, texts = four_languages
    for text in [*[t[:60] for t in texts[:25]], "de", "es ist", "la", "é"]:
        def winner(classes, machines):
            votes, sums, least = (dict.fromkeys(classes, v) for v in (0, 0.0, 1.0))
            for m in machines:
                p = 1 / (1 + np.exp(-np.clip(m.slope * plain_margin(m, text), -30, 30)))
                for c, q in ((m.first, p), (m.second, 1 - p)):
                    votes[c], sums[c], least[c] = votes[c] + (q > 0.5), sums[c] + q, min(least[c], q)
            best = max(classes, key=lambda c: (votes[c], sums[c]))
            return best, least[best]

        if not languages.letters(text):
            continue
        family, sure = winner(sorted(model.families), model.between)
        lang, surer = winner(model.families[family], model.within[family])
        got = model.predict([text])[0]
        assert got[0] == lang and got[1] == pytest.approx(sure * surer, abs=1e-9)
