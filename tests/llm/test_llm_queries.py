"""The registered queries on the smallest tables: names, types, and rows against brute force."""

from __future__ import annotations

import array
import re
import zlib
from hashlib import sha256

import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer, models, pre_tokenizers

from brute import components, plain_words
from tallyline.llm.registry import QUERIES
from test_llm_search import expected as contaminated
from test_llm_substring_dedup import expected as repeats_removed

TYPES = {
    "op1": "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string",
    "op2": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op3": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op4": "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean",
    "op5": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    "op6": "doc_id bigint, n_tokens bigint, score double",
    "op7": "doc_id bigint, fingerprint string, component_id bigint",
    "op8": "page_id bigint, host string, path string, rule string, verdict string",
    "op9": "doc_id bigint, number int, start bigint, secret string, score double",
    "op10": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op11": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
    "op12": "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, restored_sha256 string",
    "op13": "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string",
}


@pytest.fixture(scope="module")
def texts(spark, smallest):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{smallest}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def result(spark, smallest):
    """The rows of a query, its names and types checked."""

    def run(op):
        name = next(n for n in QUERIES if n.startswith(f"{op}_"))
        df = QUERIES[name](spark, smallest)
        found = dict(df.dtypes)
        assert {n: found[n] for n in [c.split()[0] for c in TYPES[op].split(", ")]} == dict(c.split() for c in TYPES[op].split(", "))
        return df.collect()

    return run


@pytest.mark.parametrize("op", ["op8", "op10", "op11", "op12", "op13"])
def test_names_and_types(result, op):
    assert result(op)


def ids_of(file, text, end):
    held = Tokenizer.from_file(public_tokenizers.path(file)) if file not in ids_of.__dict__ else ids_of.__dict__[file]
    held.encode_special_tokens = True
    ids_of.__dict__[file] = held
    return held.encode(text or "", add_special_tokens=False).ids + [end]


def crc(ids):
    return zlib.crc32(array.array("I", ids).tobytes())


def test_op1(result, texts):
    want = {(d, n, gone, sha256(kept.encode()).hexdigest()) for d, n, gone, kept in repeats_removed(list(texts.items()), 20)}
    assert {(r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in result("op1")} == want


def test_op2(result, texts):
    got, at = sorted(result("op2"), key=lambda r: r["doc_id"]), 0
    assert [r["doc_id"] for r in got] == sorted(texts)
    for r in got:
        ids = ids_of("byte_bpe_50k.json", texts[r["doc_id"]], 0)
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), crc(ids))
        at += len(ids)


def test_op3(result, texts, spark, smallest):
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{smallest}/documents.parquet").collect()}
    got = result("op3")
    assert {r["doc_id"]: r["held_out"] for r in got} == {d: zlib.crc32(str(d).encode()) % 3 == 1 for d in texts}
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in held) >= 0.9 * len(held)
    assert all(0 <= r["score"] <= 1 and (r["lang_pred"] == "und") == (not any(map(str.isalpha, texts[r["doc_id"]] or ""))) for r in got)


def test_op4(result, texts, spark, smallest):
    tests = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{smallest}/benchmark.parquet").collect()]
    want = {
        (d, n, hit, len(items), sha256(",".join(sorted(map(str, items))).encode()).hexdigest(), hit > 0)
        for d, n, hit, items in contaminated(list(texts.items()), tests, 10)
    }
    assert {(r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in result("op4")} == want


def test_op5(result, texts):
    got, want, sequences = result("op5"), set(), {}
    for d, t in texts.items():
        ids = ids_of("word_bpe_49k.json", t, 1)
        want |= {(d, p, at, len(ids[at : at + 4096]), crc(ids[at : at + 4096])) for p, at in enumerate(range(0, len(ids), 4096))}
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got} == want and len(got) == len(want)
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        ends = [0]
        for offset, length in sorted(parts):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= 4096


def test_op6(result, texts):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    library = Tokenizer(models.Unigram([(model.id_to_piece(i), model.get_score(i)) for i in range(model.vocab_size())], unk_id=0, byte_fallback=True))
    library.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=True)
    assert {r["doc_id"]: r["n_tokens"] for r in result("op6")} == {d: len(library.encode(t or "", add_special_tokens=False).ids) for d, t in texts.items()}


def plain_fingerprint(text):
    words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in plain_words(text)]
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_op7(result, texts):
    prints = {d: plain_fingerprint(t) for d, t in texts.items()}
    least = components(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    assert {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in result("op7")} == {(d, f"{prints[d]:016x}", least[d]) for d in prints}


def test_op9(result, texts):
    planted = {(d, m[1], m.start(1)) for d, t in texts.items() for m in re.finditer(r"(?i)\btoken = \"([0-9a-f]{40})\"", t or "")}
    got = {(r["doc_id"], r["secret"], r["start"]) for r in result("op9")}
    assert planted <= got and all(texts[d][at:].startswith(s) for d, s, at in got) and len(got) <= len(planted) + 2
