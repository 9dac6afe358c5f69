from __future__ import annotations

import array
import json
import random
import zlib

import public_tokenizers
import pyarrow.fs
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from brute import frame
from tallyline.llm import packing, piecewise, token_shards
from tallyline.llm.piecewise import PiecewiseEncoder
from tallyline.llm.token_counts import UnigramCounter, token_counts

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
AWKWARD = [
    "", " ", "\n", "  lead", "trail \n", "a  b\t c\r\nd", "don't it's we'LL", "“quoted” — x’s", "<|endoftext|> a", "á ́b ΑΣ ΑΣ.",
    "\x1c \x85 q\u00a0 \u2003 w", "日本 語\nテスト 😀", "x\x00 \x00y", "\n\nA\n B", "×÷ ab×!", "▁ a▁b", "<s> </s> <0x0A>", "w" * 300,
]


@pytest.fixture(scope="module")
def whole():
    loaded = {}
    for path in (BYTES, WORDS):
        loaded[path] = Tokenizer.from_file(path)
        loaded[path].encode_special_tokens = True
    return lambda path, text: loaded[path].encode(text or "", add_special_tokens=False).ids


ENCODERS = {BYTES: PiecewiseEncoder(BYTES, True, 500), WORDS: PiecewiseEncoder(WORDS, False, 500)}


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_pieces_give_the_ids_of_the_whole(whole, path):
    assert [array.array("I", x).tolist() for x in ENCODERS[path].encode(AWKWARD)] == [whole(path, t) for t in AWKWARD]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\r'.,a!Bé\u00a0\u2003\u0301\x00\x1c"), st.characters(codec="utf-8")), max_size=40))
def test_pieces_give_the_ids_of_any_text(text):
    for path, encoder in ENCODERS.items():
        assert array.array("I", encoder.encode([text])[0]).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_few_pieces_remembered_and_many_parts(whole, path, monkeypatch):
    """Pieces that are forgotten and met again, runs of closing signs, texts of more parts than are gathered at a time."""
    monkeypatch.setattr(piecewise, "GATHERED", 7)
    monkeypatch.setattr(piecewise, "MOST_CLOSINGS", 2)
    dice, own = random.Random(5), PiecewiseEncoder(path, path == BYTES, 20)
    texts = [" ".join("".join(dice.choices("abcXY", k=dice.randrange(1, 5))) + "".join(dice.choices(".,!", k=dice.randrange(4))) for _ in range(dice.randrange(60))) for _ in range(200)]
    for at in range(0, 200, 9):
        assert [array.array("I", x).tolist() for x in own.encode(texts[at : at + 9])] == [whole(path, t) for t in texts[at : at + 9]]
        assert len(own.earlier) < 1000
    assert own.encode([]) == [] and own.encode([None, ""]) == [b"", b""]


ROWS = [(5, "one two"), (3, None), (9, "x " * 9000), (4, ""), (None, "no key"), (7, "same"), (7, "same"), (7, "other"), (1, "<|endoftext|>")]


def test_shards_round_trip(spark, tmp_path, whole):
    path = str(tmp_path / "tokens")
    token_shards.write_tokens(frame(spark, ROWS).repartition(3), path, BYTES, end_id=0)
    got = token_shards.read_tokens(spark, path).orderBy("start").collect()
    want = sorted(whole(BYTES, t) + [0] for _, t in ROWS)
    assert [r["doc_id"] for r in got] == [None, 1, 3, 4, 5, 7, 7, 7, 9]
    assert sorted(array.array("I", bytes(r["ids"])).tolist() for r in got) == want
    at = 0
    for r in got:
        assert (r["start"], r["n_tokens"]) == (at, len(r["ids"]) // 4)
        at += r["n_tokens"]
    some = token_shards.read_tokens(spark, path, [9, 3, 77]).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["start"]) for r in some] == [(r["doc_id"], r["start"]) for r in got if r["doc_id"] in (3, 9)]


def test_a_shard_is_plain_zstandard_with_a_seek_table(tmp_path):
    file = tmp_path / "x.zst"
    ids = [array.array("I", [d] * n).tobytes() for d, n in ((1, 70_000), (2, 3), (3, 90_000), (4, 1))]
    with file.open("wb") as stream:
        writer = token_shards.ShardWriter(stream)
        for key, part in enumerate(ids):
            writer.add(key, part)
        writer.finish()
    assert zstandard.ZstdDecompressor().stream_reader(file.read_bytes(), read_across_frames=True).read() == b"".join(ids)
    local = pyarrow.fs.LocalFileSystem()
    shard = token_shards.ShardFile(local.open_input_file(str(file)))
    opened = []
    frame_of, shard.frame = shard.frame, lambda i: opened.append(i) or frame_of(i)
    assert list(shard.documents({1})) == [(1, 70_000, ids[1])] and opened == [1]
    broken = bytearray(file.read_bytes())
    broken[shard.starts[1] + 20] ^= 1
    file.write_bytes(broken)
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(token_shards.ShardFile(local.open_input_file(str(file))).documents({1}))


def test_empty_shards(spark, tmp_path):
    path = str(tmp_path / "none")
    token_shards.write_tokens(frame(spark, []), path, BYTES, end_id=0)
    assert json.loads((tmp_path / "none" / token_shards.MANIFEST).read_text()) == []
    assert token_shards.read_tokens(spark, path).collect() == []


def test_packing(spark, whole):
    rows = [*ROWS, *[(100 + i, "word " * (i * 37 % 90)) for i in range(300)]]
    got = packing.pack(frame(spark, rows), WORDS, end_id=1, room=64, open_bins=16).collect()
    want = []
    for d, t in rows:
        ids = whole(WORDS, t) + [1]
        want += [(d, p, at, len(ids[at : at + 64]), zlib.crc32(array.array("I", ids[at : at + 64]).tobytes())) for p, at in enumerate(range(0, len(ids), 64))]
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack(frame(spark, []), WORDS, end_id=1).collect() == []


@pytest.mark.parametrize("tasks", [1, 211])
def test_few_sequences_whatever_the_tasks(spark, smallest, tasks):
    """Within three hundredths of the least that the tokens need."""
    docs = spark.read.parquet(f"{smallest.replace('sf0.001', 'sf0.01')}/documents.parquet").repartition(tasks)
    got = packing.pack(docs, WORDS, end_id=1).agg(F.count_distinct("sequence_id").alias("used"), F.ceil(F.sum("length") / 4096).alias("least"), F.count_distinct("doc_id").alias("n")).first()
    assert got["used"] <= 1.03 * got["least"] and got["n"] == docs.count()


def test_many_tasks_at_the_second_time(spark, whole, monkeypatch):
    monkeypatch.setattr(packing, "SECOND_SEQUENCES", 3)
    rows = [(i, "word " * (i * 37 % 90)) for i in range(200)] + [(None, "word")] * 20
    got = packing.pack(frame(spark, rows).repartition(20), WORDS, end_id=1, room=64, open_bins=4).collect()
    assert sum(r["length"] for r in got) == sum(len(whole(WORDS, t)) + 1 for _, t in rows)
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        ends = [sum(n for _, n in sorted(parts)[:i]) for i in range(len(parts) + 1)]
        assert [offset for offset, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 64


def test_open_bins_are_bounded_and_the_fullest_closes():
    bins, dice = packing.OpenBins(100, 5), random.Random(1)
    for _ in range(2000):
        bins.place(dice.randrange(1, 101))
        held = [f for f, own in enumerate(bins.by_free) for _ in own]
        assert len(held) == bins.open <= 5 and bins.free == sum(1 << f for f in set(held))
    bins = packing.OpenBins(10, 2)
    assert [bins.place(n) for n in (6, 7, 9, 4, 1)] == [(0, 0), (1, 0), (2, 0), (0, 6), (2, 9)]


def test_counts_are_those_of_the_unigram_tokenizer(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    vocabulary = [(model.id_to_piece(i), model.get_score(i)) for i in range(model.vocab_size())]
    library = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=True))
    library.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=True)
    rows = [*enumerate([*AWKWARD, "the quick brown fox\njumps  over 12345 naïve Ωmegas " * 50]), (None, None), (1, "again")]
    got = frame(spark, rows).select("doc_id", "text", token_counts(F.col("text"), PIECES).alias("c")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["c"]["n_tokens"] == len(library.encode(r["text"] or "", add_special_tokens=False).ids), r["text"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("ab▁é", min_size=1, max_size=3), st.integers(-6, -1)), min_size=1, max_size=12, unique_by=lambda p: p[0]), st.text("ab cé", max_size=12))
def test_ties_and_unknown_characters(pieces, text):
    pieces = [(p, float(s)) for p, s in pieces]
    library = Tokenizer(models.Unigram([("<unk>", 0.0), *pieces], unk_id=0, byte_fallback=False))
    library.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=True)
    assert UnigramCounter(pieces, False).count([text])[0][0] == len(library.encode(text, add_special_tokens=False).ids)


def test_no_rows_to_count(spark):
    assert frame(spark, []).select(token_counts(F.col("text"), PIECES)).collect() == []
