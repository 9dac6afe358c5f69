from __future__ import annotations

import pytest

import corpus_pipeline
from compare import duck, plain, rows_as_frame
from tallyline.llm import decontamination, simhash
from tallyline.llm.registry import ORACLES, QUERIES

COLUMNS = corpus_pipeline.COLUMNS


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_result_as_sql(spark, smallest, name):
    df, cursor = QUERIES[name](spark, smallest), duck(smallest).execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert plain(rows_as_frame(df.collect(), df.columns)).equals(plain(rows_as_frame(cursor.fetchall(), names)))


def test_every_operator_has_a_query():
    assert {n.split("_")[0] for n in QUERIES} == {"pipeline", "quality", *[f"op{n}" for n in range(1, 14)]}


def test_pipeline_against_plain_stages(spark, smallest, tmp_path):
    """Each stage on all that its predecessor kept, held against a plain version."""
    docs = spark.read.parquet(f"{smallest}/documents.parquet")
    texts = {0: {r["doc_id"]: r["text"] for r in docs.collect()}}
    counts = {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES, 1):
        made = stage(spark, docs, smallest)
        made.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        counts[name] = docs.count()
        if number < 5:
            assert docs.columns == COLUMNS
            texts[number] = {r["doc_id"]: r["text"] for r in docs.collect()}
            assert counts[name] == len(texts[number])
    assert texts[1] == texts[0]  # all have a language
    prints = {d: simhash.fingerprint(t, 4) for d, t in texts[1].items()}
    left = set(prints)
    for d in sorted(prints):
        if d in left:
            group, new = {d}, [d]
            while new:
                one = new.pop()
                near = {o for o in left - group if ((prints[one] ^ prints[o]) & ((1 << 64) - 1)).bit_count() <= 4}
                group, new = group | near, [*new, *near]
            left -= group - {min(group)}
    assert set(texts[2]) == left and len(left) < len(prints)
    windows = set()
    for r in spark.read.parquet(f"{smallest}/benchmark.parquet").collect():
        w = decontamination.words(r["text"])
        windows |= {tuple(w[i : i + 10]) for i in range(len(w) - 9)}
    hit = {d for d, t in texts[2].items() if any(tuple(w[i : i + 10]) in windows for w in [decontamination.words(t)] for i in range(len(w) - 9))}
    assert set(texts[3]) == set(texts[2]) - hit
    assert set(texts[4]) == set(texts[3])
    assert {r["doc_id"] for r in docs.collect()} == set(texts[4])


def test_odd_documents(spark, smallest):
    rows = [(1, None, "de", "s", 0), (2, "", "de", "s", 0), (3, "12 34", None, None, None), (4, "der und das", "de", "s", 11), (4, "der und das", "de", "s", 11), (None, "the and of", "en", "s", 10)]
    docs = spark.createDataFrame([(*r, "e", "e") for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, found string, `__lang` string")
    for _, stage in corpus_pipeline.STAGES[:4]:
        assert stage(spark, docs, smallest).columns == COLUMNS
        assert stage(spark, docs.limit(0), smallest).collect() == []
    kept = corpus_pipeline.language_id(spark, docs, smallest)
    assert {r["doc_id"] for r in kept.collect()} == {4, None}
    assert len(corpus_pipeline.best_fit_packing(spark, docs, smallest).collect()) == len(rows)
